"""The retail star schema expressed over the generic order-management tables.

Lines, orders, parts, suppliers, customers and events are read as the raw (bronze) layer of the
retail model. Every column is a pure function of the row it comes from, so the work grows with
the tables. Duplicated line keys, shipments before the order date and other faults of the data
pass through unchanged; spellings and gaps that the cleaning rules look for are derived from
keys, as listed in ``oracles/prelude.py`` in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.functions.dates import calendar_fields, date_key
from marginflow.functions.numeric import MONEY
from marginflow.settings import DEFAULT, WEEKEND_DAYS, Settings
from marginflow.sources import inline
from marginflow.sources.layers import INGEST, with_ordinal
from marginflow.sources.scratch import durable

AS_OF = 20010630
LISTINGS_PER_SELLER = 20


# Columns the bridge reads, with their declared types
GENERIC_DDL = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "ts timestamp_ntz, user_id bigint, event_type string",
}


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GENERIC_DDL[name]).parquet(f"{folder}/{name}.parquet")


def _hundredths(c: Column) -> Column:
    """A two-place double as a whole number of hundredths; cheaper than a cast to decimal."""
    return F.floor(c * 100 + 0.5)


def _share(c: Column) -> Column:
    return (_hundredths(c).cast("decimal(4,0)") * F.lit("0.01").cast("decimal(2,2)")) \
        .cast("decimal(4,2)")


def _pick(key: Column, *choices: Column | str | None) -> Column:
    """The choice numbered ``key`` modulo the number of choices."""
    n = len(choices)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, choice in enumerate(choices):
        out = out.when(key % n == i, choice if isinstance(choice, Column) else F.lit(choice))
    return out


def _line_id() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _unit_price() -> Column:
    """A hundredth of the extended price, exact to four places."""
    units = _hundredths(F.col("l_extendedprice")).cast("decimal(14,0)")
    return (units * F.lit("0.0001").cast("decimal(4,4)")).cast(MONEY)


def _order_heads(spark: SparkSession, folder: str) -> DataFrame:
    """What all lines of an order share, worked out once per order before the lines join."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    method = F.when(F.lit(False), F.lit(""))
    for raw, written in (("1-URGENT", "COD"), ("2-HIGH", " cod "), ("3-MEDIUM", "card"),
                         ("4-NOT SPECIFIED", "Wallet"), ("5-LOW", "bnpl")):
        method = method.when(priority == raw, written)
    return (scan(spark, folder, "orders")
            .join(scan(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"),
                  "left")
            .select("o_orderkey", status,
                    date_key(day).alias("order_date_key"),
                    F.col("c_nationkey").cast("bigint").alias("geo_id"),
                    method.otherwise(priority).alias("payment_method"),
                    date_key(F.date_add(day, 90)).alias("promised_delivery_date_key")))


def raw_orders(spark: SparkSession, folder: str, ordinal: bool = False) -> DataFrame:
    """Order lines; with ``ordinal`` also the place of each line in its file (``INGEST``)."""
    heads, lines = _order_heads(spark, folder), scan(spark, folder, "lineitem")
    if ordinal:
        lines = with_ordinal(lines, "parquet")
    joined = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    done, cancelled = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    status = (F.when(done, "delivered").when(cancelled, "cancelled_pre_shipment")
              .when(F.col("l_linenumber") % 2 == 1, "rto_customer_refused")
              .otherwise("rto_unreachable"))
    discount = _share(F.col("l_discount"))
    arrived = (done & (F.col("l_orderkey") % 101 != 0)) | (F.col("l_linenumber") == 7)
    return joined.select(
        _line_id().alias("order_line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("listing_id"),
        F.col("l_suppkey").alias("seller_id"),
        "order_date_key", "geo_id", "payment_method",
        F.when(F.col("l_orderkey") % 97 == 13, F.lit(-1))
        .otherwise(F.col("l_quantity")).cast("bigint").alias("quantity"),
        _unit_price().alias("unit_selling_price"),
        F.round(_unit_price() * discount, 4).cast(MONEY).alias("item_discount_amount"),
        F.when(F.col("l_tax") > 0, _hundredths(F.col("l_tax"))).cast(MONEY)
        .alias("shipping_fee_charged"),
        "promised_delivery_date_key",
        F.when(arrived, date_key(F.col("l_shipdate").cast("date")))
        .alias("actual_delivery_date_key"),
        F.when(cancelled, F.lit(0)).otherwise(F.col("l_quantity") % 3 + 1).cast("bigint")
        .alias("delivery_attempts"),
        status.alias("order_status"),
        *([INGEST] if ordinal else []),
    )


def raw_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Every returned line, also those whose order was never delivered; checks report them."""
    lines = scan(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    shipped = F.col("l_shipdate").cast("date")
    initiated = F.date_add(shipped, F.col("l_linenumber") - 2)
    received = F.date_add(initiated, (F.col("l_quantity") % 5 - 1).cast("int"))
    quantity = F.floor((F.col("l_quantity") + 1) / 2).cast("bigint")
    reason = F.concat(F.lit("R0"), F.lpad((F.col("l_orderkey") % 10 + 1).cast("string"), 2, "0"))
    paid = F.lit(1).cast("decimal(4,2)") - _share(F.col("l_discount"))
    return lines.select(
        _line_id().alias("return_id"),
        _line_id().alias("order_line_id"),
        date_key(initiated).alias("return_initiated_date_key"),
        date_key(received).alias("return_received_date_key"),
        F.when(F.col("l_orderkey") % 97 != 0, reason).alias("reported_reason_code"),
        _pick(F.col("l_linenumber"), "resellable", "RESELLABLE", " refurbishable", "write off",
              "refurbishable").alias("item_condition_on_receipt"),
        quantity.alias("quantity_returned"),
        F.round((quantity.cast("decimal(9,0)") * _unit_price()).cast(MONEY) * paid, 4)
        .cast(MONEY).alias("refund_amount"),
        _pick(F.col("l_linenumber"), "wallet", "card").alias("refund_method"),
    )


def raw_listings(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    category = (F.when(key % 211 == 0, "Garden")
                .when(F.col("p_type") == "ECONOMY", "Fashion")
                .when(F.col("p_type") == "LARGE", " fashion")
                .when(F.col("p_type") == "STANDARD", "Electronics")
                .when(F.col("p_type") == "PROMO", "HOME")
                .when(F.col("p_type") == "MEDIUM", "beauty ")
                .when(F.col("p_type") == "SMALL", "Sports")
                .otherwise(F.col("p_type")))
    return scan(spark, folder, "part").select(
        key.alias("listing_id"),
        F.floor(key / LISTINGS_PER_SELLER).cast("bigint").alias("seller_id"),
        category.alias("category"),
        F.col("p_name").alias("subcategory"),
        F.when(key % 29 == 0, "N/A").when(key % 31 == 0, " none ")
        .otherwise(F.col("p_brand")).alias("brand"),
        F.when(key % 37 != 0, F.col("p_retailprice")).cast(MONEY).alias("price"),
        ((key % 13) / F.lit(10.0)).alias("discount_pct"),
        F.when(key % 43 == 0, F.lit(-1)).otherwise(size % 7).cast("bigint").alias("image_count"),
        (key % 3 == 0).alias("has_video"),
        (F.length("p_name") * 4).cast("bigint").alias("title_length_chars"),
        F.when(key % 17 != 0, size * F.lit(8.0)).alias("description_length_chars"),
        F.when(key % 19 != 0, (key % 11) / F.lit(10.0)).alias("specifications_filled_pct"),
        F.when(key % 23 != 0, key % 2 == 0).alias("has_size_chart"),
        F.when(key % 27 != 0, key % 5 < 2).alias("has_dimensions_listed"),
        (size % 4).cast("bigint").alias("variant_count"),
        F.when(key % 41 != 0, size * F.lit(0.3)).alias("item_weight_kg"),
    )


def raw_sellers(spark: SparkSession, folder: str) -> DataFrame:
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    return scan(spark, folder, "supplier").select(
        key.alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.when(key % 37 == 5, "n/a").when(balance < 0, F.lit(None)).when(balance < 3000, "T3")
        .when(balance < 6500, "T2").otherwise("T1").alias("seller_tier"),
        _pick(key, "marketplace_fulfilled", "Seller Fulfilled", " seller_fulfilled",
              "MARKETPLACE FULFILLED").alias("fulfillment_type"),
        _pick(F.col("s_nationkey"), "local", "cross border", "LOCAL", "cross_border")
        .alias("seller_country"),
    )


def raw_geography(spark: SparkSession, folder: str) -> DataFrame:
    zone = _pick(F.col("r_regionkey"), "urban_core", "suburban", "remote")
    return (scan(spark, folder, "nation")
            .join(scan(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").cast("bigint").alias("geo_id"),
                    F.col("r_name").alias("emirate"), F.col("n_name").alias("city"),
                    zone.alias("zone_type"), zone.alias("logistics_zone")))


def raw_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Days from the first order up to the last one; promised dates lie beyond."""
    day = F.col("full_date")
    fields = calendar_fields(day, WEEKEND_DAYS)
    month, dom = F.month(day), F.dayofmonth(day)
    days = (scan(spark, folder, "orders")
            .agg(F.min("o_orderdate").cast("date").alias("a"),
                 F.max("o_orderdate").cast("date").alias("b"))
            .select(F.explode(F.sequence("a", "b")).alias("full_date")))
    return days.select(
        *[c.alias(n) for n, c in fields.items()],
        (month == 3).alias("is_ramadan"),
        ((month == 4) & (dom <= 3)).alias("is_eid_period"),
        ((month == 11) & (dom >= 20)).alias("is_white_friday_period"),
        ((month == 12) & (dom <= 3)).alias("is_uae_public_holiday"),
    )


def raw_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """Daily funnel of a listing: views, clicks and purchases of the event stream."""
    kind = F.col("event_type")
    bought = F.count_if(kind == "purchase")
    return (scan(spark, folder, "events")
            .groupBy(F.col("user_id").alias("listing_id"), date_key(F.col("ts")).alias("date_key"))
            .agg(F.count_if(kind == "view").alias("impressions"),
                 F.count_if(kind == "click").alias("detail_page_views"),
                 F.when(bought > 0, bought.cast("double")).alias("add_to_carts")))


class RawLayer(Mapping):
    """The ten bronze tables over one folder of generic tables, each planned on first use."""

    _tables = {
        "dim_date": raw_calendar,
        "dim_geography": raw_geography,
        "dim_return_reason": lambda spark, folder: inline.return_reasons(spark),
        "dim_seller": raw_sellers,
        "dim_listing": raw_listings,
        "fact_listing_traffic": raw_traffic,
        "fact_orders": raw_orders,
        "fact_returns": raw_returns,
        "ref_category_economics": lambda spark, folder: inline.category_economics(spark),
        "ref_logistics_rate_card": lambda spark, folder: inline.rate_card(spark),
    }

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._tables[name](self._spark, self._folder)
        return self._planned[name]

    def kept(self, *names: str) -> RawLayer:
        """The same layer with some tables written once, for queries that read them several
        times: the joins and sums behind them are not done again for each reader."""
        out = RawLayer(self._spark, self._folder)
        out._planned = self._planned | {n: durable(self[n], f"raw-{n}") for n in names}
        return out

    def order_lines_as_ingested(self) -> DataFrame:
        return raw_orders(self._spark, self._folder, ordinal=True)

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def bridge_settings() -> Settings:
    """Rules for the bridged data, whose line keys repeat and whose history ends in 2001."""
    cleaning = dict(DEFAULT.cleaning)
    cleaning["fact_orders"] = replace(cleaning["fact_orders"], dedup_key=("order_line_id",))
    return replace(DEFAULT, as_of_date_key=AS_OF, cleaning=cleaning)
