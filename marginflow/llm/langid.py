"""Language identification by compression.

Every language gets a zstandard raw-content dictionary: text of that language, nothing trained.
A text, in lower case, is compressed with each dictionary; the language whose dictionary makes
it smallest wins, and the prediction is rejected when the runner-up comes too close. A very short
text is stored as it is, in the same size whatever the dictionary; it is repeated and measured again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER = r"\p{L}"
SCHEMA = ("doc_id long, lang_pred string, score double, rejected boolean, margin double, "
          "tied boolean")


@dataclass(frozen=True)
class Compression:
    """Parameters of the classifier.

    ``dictionary_chars`` bounds the text learned per language and ``model_chars`` that of all
    languages together, each of which then gets an equal share: no language is left out.
    ``sample_chars`` is the length of a passage.
    ``piece_bytes``: texts are compressed in pieces of this size, so that the dictionary keeps
    its weight in a long text. ``min_margin``: the least advantage over the runner-up, as a
    share of its size. ``repeats``: how often a text stands that all dictionaries store alike.
    """

    dictionary_chars: int = 100_000
    sample_chars: int = 600
    model_chars: int = 20_000_000
    piece_bytes: int = 1024
    level: int = 7
    min_margin: float = 0.003
    repeats: int = 4


def learn(labelled: DataFrame, rules: Compression = Compression()) -> dict[str, str]:
    """lang -> dictionary text, from ``labelled(doc_id, text, lang)``.

    A bounded sample: per language the texts that come first in a hash order of their ids, one
    passage of each from a hashed place, until the share of the language is full. Where no letter
    stands in that passage it begins at the first letter of the text. The order is taken with an
    aggregate that keeps the k smallest per task, so no group is gathered. Null languages and
    texts without letters teach nothing.
    """
    place = F.xxhash64(F.col("doc_id").cast("string"))
    size = F.lit(rules.sample_chars)
    room = F.greatest(F.length("text") - size, F.lit(0)) + 1
    hashed = F.substring(F.col("text"), (F.pmod(place, room) + 1).cast("int"), size)
    letters = F.substring(F.col("text"), F.regexp_instr("text", F.lit(LETTER)), size)
    usable = (labelled.select("doc_id", "text", F.col("lang").alias("language"))
              .filter(F.col("language").isNotNull() & F.col("text").rlike(LETTER))
              .select("language", place.alias("place"),
                      F.lower(F.when(hashed.rlike(LETTER), hashed).otherwise(letters))
                      .alias("passage")))
    languages = usable.select("language").distinct().count()
    share = min(rules.dictionary_chars, rules.model_chars // max(languages, 1))
    passages = max(1, share // rules.sample_chars)
    nearest = Window.partitionBy("language").orderBy("place", "passage")
    # Catalyst keeps `passages` rows per language and task before the shuffle
    kept = (usable.withColumn("rank", F.row_number().over(nearest))
            .filter(F.col("rank") <= passages)
            .groupBy("language").agg(F.sort_array(F.collect_list(F.struct("rank", "passage")))
                                     .alias("passages")))
    return {row.language: "\n".join(p.passage for p in row.passages) for row in kept.collect()}


def _compressors(model: dict[str, str], rules: Compression) -> list:
    import zstandard

    out = []
    for text in model.values():
        content = zstandard.ZstdCompressionDict(text.encode(),
                                                dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=rules.level)
        out.append(zstandard.ZstdCompressor(level=rules.level, dict_data=content,
                                            write_checksum=False, write_content_size=False,
                                            write_dict_id=False))
    return out


def identify(docs: DataFrame, model: dict[str, str],
             rules: Compression = Compression()) -> DataFrame:
    """(doc_id, lang_pred, score, rejected, margin, tied), one row per row of ``docs``.

    ``lang_pred`` is the language with the smallest total, ties going to the first name; 'und'
    when the text is null, has no letter, or nothing was learned. ``tied``: all of several languages
    have the same total, even with the text repeated. ``score`` is the share of the
    winner when each language weighs 2^-(8 * extra bytes / pieces). ``rejected`` marks 'und' and
    margins under ``min_margin``. Null ids stay null; repeated rows give repeated results; other
    columns are ignored.
    """
    names = sorted(model)
    ordered = {name: model[name] for name in names}

    def measured(tools: list, pieces: list[bytes]) -> np.ndarray:
        return np.array([sum(len(tool.compress(p)) for p in pieces) for tool in tools], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(LETTER)
        tools = _compressors(ordered, rules)
        for batch in batches:
            found = []
            for cell in batch.column(1):
                text = cell.as_py()
                if not text or not names or not letter.search(text):
                    found.append((UNKNOWN, 0.0, True, 0.0, False))
                    continue
                raw = text.lower().encode()
                pieces = [raw[i:i + rules.piece_bytes]
                          for i in range(0, len(raw), rules.piece_bytes)]
                sizes = measured(tools, pieces)
                if np.ptp(sizes) == 0:
                    sizes = measured(tools, [b"\n".join([p] * rules.repeats) for p in pieces])
                best = int(sizes.argmin())
                rest = np.delete(sizes, best)
                margin = float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0
                weights = np.exp2(-np.minimum(8 * (sizes - sizes[best]) / len(pieces), 1000))
                found.append((names[best], float(1 / weights.sum()), margin < rules.min_margin,
                              margin, len(sizes) > 1 and np.ptp(sizes) == 0))
            columns = zip(*found) if found else [()] * 5
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.float64(), pa.bool_())
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "lang_pred", "score", "rejected", "margin", "tied"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, SCHEMA)


def tied(rows: DataFrame):
    """Whether no dictionary shows anything about a text that has letters."""
    return rows["tied"]


def held_out(column: str = "doc_id"):
    """The fold that is never learned from."""
    return F.crc32(F.col(column).cast("string")) % 5 == 0


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred",
                                        "score", "rejected", "margin", "tied")
