"""File scans that lose nothing, ingest order, publication in one step, shared folders."""

import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marginflow.functions.text import casefold, folded
from marginflow.operators import cleaning as C
from marginflow.plans.layout import by_key
from marginflow.plans.warehouse import Warehouse
from marginflow.settings import CleaningRules, Settings
from marginflow.sources import files, publish, scratch
from marginflow.sources.layers import (
    INGEST, CsvScan, FileLayer, MissingTable, quarantine_counts, read_layer, with_ordinal,
    write_layer, write_quarantine,
)

DDL = "id string, n int, day date, ok boolean, price decimal(18,4)"
LINES = ["id,n,day,ok,price",
         "1,3,2020-01-02,true,1.5",
         "2,three,2020-13-02,true,AED 1",
         "3,4,2020-01-02,true",
         "4,4,2020-01-02,true,2.0,extra",
         "5,,,,",
         '6,"7","2020-01-02",maybe,1.23456',
         "7,n/a, - ,NULL,nan",
         " x ,99999999999,2020-01-02,false,1"]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "a.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path)


def test_csv_scan_keeps_what_does_not_fit(spark, folder):
    scan = CsvScan(spark, f"{folder}/t.csv", DDL)
    rows = {r.id: r for r in scan.table.collect()}
    assert set(rows) == {"1", "2", "5", "6", "7", " x "}  # margins of a cell are data
    assert scan.table.dtypes == [("id", "string"), ("n", "int"), ("day", "date"),
                                 ("ok", "boolean"), ("price", "decimal(18,4)")]
    assert rows["6"].n == 7 and rows["6"].price == D("1.2346") and rows["6"].ok is None
    cells = {(r.column_name, r.value) for r in scan.bad_cells.collect()}
    assert cells == {("n", "three"), ("day", "2020-13-02"), ("price", "AED 1"), ("ok", "maybe"),
                     ("n", "99999999999")}  # missing values are no faults
    assert sorted(r.record for r in scan.bad_rows.collect()) == [LINES[3], LINES[4]]
    faults = {r.column_name: r.faults for r in scan.faults().collect()}
    assert faults == {"*": 2, "n": 2, "day": 1, "price": 1, "ok": 1}
    # few columns asked for: widths are still told
    assert scan.table.select("id").count() == 6 and scan.bad_rows.select("block").count() == 2


def test_quarantine_is_written_by_table(spark, folder, tmp_path):
    scans = {"t": CsvScan(spark, f"{folder}/t.csv", DDL), "s": CsvScan(spark, f"{folder}/t.csv", "a string")}
    counts = {(r.table_name, r.column_name): r.faults for r in quarantine_counts(scans).collect()}
    assert counts["t", "*"] == 2 and counts["s", "*"] == 8 and counts["t", "n"] == 2
    out = str(tmp_path / "aside")
    write_quarantine(scans, out)
    cells = spark.read.parquet(f"{out}/cells")
    assert cells.filter("table_name = 't'").count() == 5
    assert cells.select("file").first()[0].endswith("a.csv")
    assert spark.read.parquet(f"{out}/rows").groupBy("table_name").count().count() == 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_first_row_wins_over_several_files(spark, tmp_path, fmt):
    """The first of equally complete rows stays, in the order of file names and lines; a more
    complete one that comes later still wins."""
    rows = [[(k, f"{part}-{i}", None if k == 3 and part < 2 else 1) for i, k in enumerate(
        [1, 1, 2 + part % 2, 3] * 50)] for part in range(3)]
    for part, content in enumerate(rows):  # later files are written first
        df = spark.createDataFrame(content, "k int, t string, v int").coalesce(1)
        target = str(tmp_path / f"w{part}")
        df.write.csv(target, header=True) if fmt == "csv" else df.write.parquet(target)
    home = tmp_path / ("t.csv" if fmt == "csv" else "t")
    home.mkdir()
    for part in (2, 0, 1):
        made = next((tmp_path / f"w{part}").glob(f"part-*.{fmt}"))
        (home / f"part-{part}.{fmt}").write_bytes(made.read_bytes())
    if fmt == "csv":
        df = CsvScan(spark, str(home), "k int, t string, v int").ordered
    else:
        df = with_ordinal(spark.read.parquet(str(home)), "parquet")
    df = df.repartition(7)  # whatever happens to the rows later
    expected = {}
    for part in range(3):
        for k, t, v in rows[part]:
            if k not in expected or (expected[k][1] is None and v is not None):
                expected[k] = (t, v)
    out = C.deduplicate(df, ["k"])
    assert out.columns == ["k", "t", "v"]
    assert {r.k: (r.t, r.v) for r in out.collect()} == expected
    again = C.clean_table(df, CleaningRules(dedup_key=("k",)), Settings())
    assert {r.k: (r.t, r.v) for r in again.collect()} == expected and INGEST not in again.columns


def test_warehouse_cleans_file_layers_in_ingest_order(spark, tmp_path):
    table = spark.createDataFrame([("S1", "Zed"), ("S1", "Abe")], "seller_id string, seller_name string")
    write_layer({"dim_seller": table.coalesce(1)}, str(tmp_path))
    layer = read_layer(spark, str(tmp_path), ["dim_seller"], "parquet")
    assert isinstance(layer, FileLayer) and layer["dim_seller"].columns == table.columns
    settings = Settings(cleaning={"dim_seller": CleaningRules(dedup_key=("seller_id",))})
    assert Warehouse(layer, settings).cleaned("dim_seller").collect() == [("S1", "Zed")]
    # rows without an order: the smallest
    plain = {"dim_seller": table}
    assert Warehouse(plain, settings).cleaned("dim_seller").collect() == [("S1", "Abe")]


def test_enum_rules_for_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1, "A b")], "k int, c string")
    rules = CleaningRules(enums={"c": ("a_b",), "missing": ("x",)})
    assert C.clean_table(df, rules, Settings()).collect() == [(1, "a_b", True)]
    assert C.rule_errors(df, rules) == [("normalize_enum", "missing", "column missing")]


# -- publication --------------------------------------------------------------------------------
def numbers(spark, n):
    return {name: spark.range(n).withColumn("of", F.lit(name)) for name in ("a", "b", "c")}


def seen(spark, folder):
    return {name: df.count() for name, df in publish.published(spark, folder).items()}


def test_a_build_that_dies_leaves_the_old_layer(spark, tmp_path):
    folder = str(tmp_path / "gold")
    with pytest.raises(MissingTable):
        publish.published(spark, folder)
    publish.publish(spark, numbers(spark, 3), folder)
    old = publish.published(spark, folder)
    broken = numbers(spark, 5)
    broken["c"] = broken["c"].select(F.raise_error(F.lit("executor lost")).alias("x"))
    with pytest.raises(Exception, match="executor lost"):
        publish.publish(spark, broken, folder)  # dies after two of three tables
    assert seen(spark, folder) == {"a": 3, "b": 3, "c": 3}
    killed = publish.Publication(spark, folder)  # no clean-up either, as when the driver dies
    killed.write("a", spark.range(9))
    assert seen(spark, folder) == {"a": 3, "b": 3, "c": 3}
    publish.publish(spark, numbers(spark, 7), folder)
    assert seen(spark, folder) == {"a": 7, "b": 7, "c": 7}
    assert old["a"].count() == 3  # a reader of the version before goes on


def test_refused_and_old_versions_go(spark, tmp_path):
    folder = str(tmp_path / "gold")

    def refuse(tables):
        raise ValueError(f"{sorted(tables)}")

    with pytest.raises(ValueError, match="'a', 'b', 'c'"):
        publish.publish(spark, numbers(spark, 1), folder, refuse)
    assert publish.current(spark, folder) is None and not files.names(spark, folder)
    for n in range(1, 5):
        publish.publish(spark, numbers(spark, n), folder)
    kept = [n for n in files.names(spark, folder) if n != publish.POINTER]
    assert [n[:9] for n in kept] == ["v00000003", "v00000004"]
    assert seen(spark, folder)["a"] == 4


# -- scratch ------------------------------------------------------------------------------------
class _Session:
    """Just what ``shared_folder`` asks of a session."""

    def __init__(self, master, **conf):
        self.sparkContext, self._conf = self, conf
        self.master, self.conf = master, self

    def get(self, key, default=None):
        return self._conf.get(key.rsplit(".", 2)[1], default)


def test_machine_local_folders_are_refused_on_a_cluster():
    assert scratch.shared_folder(_Session("local[2]", warehouse="file:/w")) == "file:/w/_scratch"
    for warehouse in ("file:/w", "/w", "file:///w"):
        with pytest.raises(scratch.LocalFolder):
            scratch.shared_folder(_Session("spark://h:7077", warehouse=warehouse))
    shared = _Session("yarn", warehouse="hdfs://n/w")
    assert scratch.shared_folder(shared) == "hdfs://n/w/_scratch"
    named = _Session("yarn", warehouse="/w", checkpoint="/mnt/shared/")
    assert scratch.shared_folder(named) == "/mnt/shared"


def test_past_tables_are_discarded(spark):
    table = scratch.durable(spark.range(3))
    path = table._durable_path
    assert table.count() == 3 and files.exists(spark, path)
    scratch.discard(table, spark.range(2))
    assert not files.exists(spark, path)


# -- folding ------------------------------------------------------------------------------------
def test_folding_equals_full_unicode_folding(spark):
    words = ["STRASSE", "Straße", "ΟΔΟΣ", "Οδός", "ﬁne", "ŉ", "İstanbul", "ǅ", "ß", "ẞ", "ﬃ", "",
             "plain ASCII", "ᾳ", "ꭰ", "Ꭰ", "Σς", "K", "mixed ÄÖÜ und ΣΣ"]
    words += [chr(c) for c in range(0x80, 0x3000)]
    df = spark.createDataFrame(list(enumerate(words)), "i int, w string")
    out = {r.i: r.f for r in df.select("i", casefold(F.col("w")).alias("f")).collect()}
    wrong = {words[i] for i, f in out.items() if f != words[i].casefold()}
    assert wrong <= {"\u1c89"}  # assigned after the Unicode version of the JVM
    trimmed = spark.range(1).select(folded(F.lit(" Straße\t"))).first()[0]
    assert trimmed == "strasse"
    canonical = spark.createDataFrame([("STRASSE",), ("straße ",)], "category string")
    out = C.normalize_category(canonical, "category", ["Straße"])
    assert {r.category for r in out.collect()} == {"Straße"}


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(name) for name in disk.getAllFiles().mkString("\n").split("\n")
            if "/shuffle_" in name}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """What a stored, published or bucketed table was shuffled through goes with the write, and
    the session's own setting comes back."""
    rows = spark.range(5_000).selectExpr("id", "id % 7 AS k").repartition(3, "k")
    before, set_before = _shuffle_files(spark), spark.conf.get(scratch.CLEANUP)
    stored = scratch.durable(rows, "freed")
    publish.publish(spark, {"t": rows}, str(tmp_path / "layer"))
    keyed = by_key(rows, "k", 2)
    deadline = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(scratch.CLEANUP) == set_before
    assert stored.count() == keyed.count() == 5_000
