"""Personal data by bootstrapped contextual extraction.

Four kinds of base entities (email, ip, card, phone) are found by form and seed the rest. The
words around a seed are lexical patterns. Every token, of any form, that stands in a pattern with
enough seeds is a possible instance. Spark scores the bipartite pattern-instance graph in
rounds: a pattern is worth the mean of its instances, an instance the best of its patterns, and
seeds stay at 1. Patterns that end up reliable mark the instances they surround as personal
data of the kind their seeds had. These become seeds in turn: the texts are searched for the other
places where they stand, whose patterns may gain enough seeds, until no new values appear.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.sources.scratch import durable

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?()[]{}<>\"'|*#%$&="
_RUN = re.compile(r"(.)\1+")


@dataclass(frozen=True)
class Bootstrapping:
    """``rounds`` of scoring; a pattern is trusted from ``min_score`` on when at least
    ``min_seeds`` different seed values, found by form or gained, have been seen in it. Only then, and
    if seeds are at least ``min_share`` of all tokens in it, are its other tokens looked at: words
    between "the" and "of" are no identifiers, whatever stood there once.
    ``context_chars``: how far to either side the surrounding words reach. The texts are searched
    for ``block`` patterns or values at a time, in as many passes as that takes."""

    rounds: int = 3
    min_score: float = 0.9
    min_seeds: int = 5
    min_share: float = 0.25
    context_chars: int = 80
    block: int = 50_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and dotted domain. The text is scanned by its
    ``@`` signs, so a long run of letters without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind as in ``KINDS``, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def shape(token: str) -> str:
    """Letters as a and A, digits as 9, runs once, other characters as they are."""
    coarse = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
                     for c in token[:64])
    return _RUN.sub(r"\1", coarse)


def _patterns(text: str, start: int, end: int, reach: int) -> list[str]:
    """What surrounds a span: two words before, one word each side, one word and the form.
    Quotes, brackets and the like that touch the span belong to neither; words longer than
    ``reach`` are none."""
    form = shape(text[start:end])
    while start > 0 and text[start - 1] in _EDGE:
        start -= 1
    while end < len(text) and text[end] in _EDGE:
        end += 1
    near = text[max(0, start - 4 * reach):start].lower().split()[-2:]
    far = text[end:end + 4 * reach].lower().split()[:1]
    clean = [w.strip(_EDGE) if len(w) <= reach else "" for w in near]
    follow = far[0].strip(_EDGE) if far and len(far[0]) <= reach else ""
    out = []
    if len(clean) == 2 and all(clean):
        out.append(f"b {clean[0]} {clean[1]}")
    if clean and clean[-1] and follow:
        out.append(f"s {clean[-1]} _ {follow}")
    if clean and clean[-1]:
        out.append(f"l {clean[-1]} {form}")
    return [p[:160] for p in out]


def _left_word(pattern: str) -> str:
    """The word right before the span, which every pattern names."""
    kind, rest = pattern[0], pattern[2:].split(" ")
    return rest[1] if kind == "b" and len(rest) > 1 else rest[0]


def value_of(token: str) -> str:
    """Name of a value in tables: a checksum, to find it quickly, and a digest."""
    raw = token.lower().encode()
    return f"{zlib.crc32(raw):08x}{hashlib.blake2b(raw, digest_size=12).hexdigest()}"


def _failed_form(token: str) -> bool:
    """Written like a card, an address of a machine or a phone number, and found to be none."""
    if _CARD.fullmatch(token):
        return 13 <= sum(c.isdigit() for c in token) <= 19
    return bool(_IP.fullmatch(token) or _PHONE.fullmatch(token))


class _Contexts:
    """Patterns by the word on the left, to look for tokens in them word by word."""

    def __init__(self, patterns: list[str], reach: int):
        self.reach, self.forms_of, self.patterns = reach, {}, set(patterns)
        # left word -> patterns by the word before it, by the word that follows, by form
        self.by_left: dict[str, tuple[dict, dict, dict]] = {}
        for p in patterns:
            kind, parts = p[0], p[2:].split(" ", 1 if p[0] == "l" else 2)
            entry = self.by_left.setdefault(_left_word(p), ({}, {}, {}))
            entry["bsl".index(kind)][parts[0] if kind == "b" else parts[-1]] = p
        self.by_left.pop("", None)

    def _form(self, token: str) -> str:
        if token not in self.forms_of:
            if len(self.forms_of) > 100_000:
                self.forms_of = {}
            self.forms_of[token] = shape(token)
        return self.forms_of[token]

    def words(self, text: str) -> list[str]:
        """The tokens of a text in lower case without edges; what is too long is none."""
        return [w.strip(_EDGE) if len(w) <= self.reach else "" for w in text.lower().split()]

    def hits(self, text: str, words: list[str]) -> Iterator[tuple[int, str]]:
        """(number of a token, pattern that it stands in)."""
        tokens, first, second = None, "", ""  # of the two words before
        for i, word in enumerate(words):
            entry = self.by_left.get(second)
            if entry is not None and word:
                before, follow, forms = entry
                if first in before:
                    yield i, before[first]
                if follow and i + 1 < len(words) and words[i + 1] in follow:
                    yield i, follow[words[i + 1]]
                if forms:
                    tokens = text.split() if tokens is None else tokens
                    form = self._form(tokens[i].strip(_EDGE))
                    if form in forms:
                        yield i, forms[form]
            first, second = second, word


def _instances(text: str, contexts: _Contexts, sums: set[int], values: set[str],
               rules: Bootstrapping) -> Iterator[tuple[int, int, str, list[str]]]:
    """(start, end, value, patterns) of the tokens that stand in one of the patterns or have one
    of ``values``, outside base spans."""
    words = contexts.words(text)
    marked = {i for i, _ in contexts.hits(text, words)}
    if sums:
        marked |= {i for i, w in enumerate(words) if zlib.crc32(w.encode()) in sums}
    if not marked:
        return
    taken, at = sorted((a, b) for _, a, b in base_spans(text)), 0
    for i, m in enumerate(_TOKEN.finditer(text)):
        if i not in marked:
            continue
        a, b = m.span()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a == b or at < len(taken) and taken[at][0] < b or _failed_form(text[a:b]):
            continue
        around, value = _patterns(text, a, b, rules.context_chars), value_of(text[a:b])
        if value in values or not contexts.patterns.isdisjoint(around):
            yield a, b, value, around


_SPAN = pa.struct([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32())])
_SEED = pa.struct([("kind", pa.int32()), ("value", pa.string()),
                   ("patterns", pa.list_(pa.string()))])
_PLACE = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("value", pa.string()),
                    ("patterns", pa.list_(pa.string()))])
_FOUND = ("k1 long, k2 long, doc_id long, spans array<struct<kind:int,a:int,b:int>>, "
          "base_sha256 string, seeds array<struct<kind:int,value:string,patterns:array<string>>>")
_PLACES = ("k1 long, k2 long, "
           "places array<struct<a:int,b:int,value:string,patterns:array<string>>>")


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _named(docs: DataFrame) -> DataFrame:
    """Rows with a name of 128 bits that follows from id and text, so that it is the same in every
    pass; rows equal in both are one."""
    doc = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = doc.isNull()  # a null leaves a hash as it is
    return docs.select(F.xxhash64(known, doc, text).alias("k1"),
                       F.xxhash64(F.lit(2), text, doc, known).alias("k2"),
                       doc.alias("doc_id"), text.alias("text"))


def _found(named: DataFrame, rules: Bootstrapping) -> DataFrame:
    """Base entities of every text, and the seeds they are with their patterns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, shas, seeds = [], [], []
            for cell in batch.column(3):
                text = cell.as_py()
                base = base_spans(text)
                spans.append([{"kind": k, "a": a, "b": b} for k, a, b in base])
                shas.append(hashlib.sha256(written(base).encode()).hexdigest())
                seeds.append([{"kind": k, "value": value_of(text[a:b]),
                               "patterns": _patterns(text, a, b, rules.context_chars)}
                              for k, a, b in base])
            yield pa.record_batch([*batch.columns[:3], pa.array(spans, pa.list_(_SPAN)),
                                   pa.array(shas, pa.string()),
                                   pa.array(seeds, pa.list_(_SEED))],
                                  names=["k1", "k2", "doc_id", "spans", "base_sha256", "seeds"])

    return named.mapInArrow(run, _FOUND)


def _searched(named: DataFrame, patterns: list[str], values: list[str],
              rules: Bootstrapping) -> DataFrame:
    """(k1, k2, a, b, value, pattern): the places of tokens in some patterns or of some values,
    with every pattern around them."""
    wanted, sums = set(values), {int(v[:8], 16) for v in values}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = _Contexts(patterns, rules.context_chars)
        for batch in batches:
            k1, k2, places = [], [], []
            for x, y, cell in zip(batch.column(0), batch.column(1), batch.column(3)):
                text = cell.as_py()
                found = list(_instances(text, contexts, sums, wanted, rules))
                if found:
                    k1.append(x.as_py())
                    k2.append(y.as_py())
                    places.append([{"a": a, "b": b, "value": v, "patterns": p}
                                   for a, b, v, p in found])
            yield pa.record_batch([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                                   pa.array(places, pa.list_(_PLACE))],
                                  names=["k1", "k2", "places"])

    return (named.mapInArrow(run, _PLACES).select("k1", "k2", F.inline("places"))
            .select("k1", "k2", "a", "b", "value", F.explode("patterns").alias("pattern")))


def _totals(named: DataFrame, patterns: list[str], rules: Bootstrapping) -> DataFrame:
    """(pattern, total): how many tokens stand in each of some patterns, seeds included. A task
    sums up before anything leaves it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, contexts = Counter(), _Contexts(patterns, rules.context_chars)
        for batch in batches:
            for cell in batch.column(3):
                text = cell.as_py()
                total.update(p for _, p in contexts.hits(text, contexts.words(text)))
        yield pa.record_batch([pa.array(list(total), pa.string()),
                               pa.array(list(total.values()), pa.int64())],
                              names=["pattern", "total"])

    counted = named.mapInArrow(run, "pattern string, total long") \
        .groupBy("pattern").agg(F.sum("total").alias("total"))
    asked = named.sparkSession.createDataFrame([(p,) for p in patterns], "pattern string")
    return asked.join(counted, "pattern", "left").select(
        "pattern", F.coalesce("total", F.lit(0)).alias("total"))


def _in_blocks(names: DataFrame, rules: Bootstrapping) -> Iterator[list[str]]:
    """The one column of a table, some rows at a time."""
    blocks = -(-names.count() // rules.block)
    name = F.col(names.columns[0])
    for i in range(blocks):
        yield [r[0] for r in names.filter(F.pmod(F.xxhash64(name), F.lit(blocks)) == i).collect()]


def pattern_scores(edges: DataFrame, rules: Bootstrapping) -> DataFrame:
    """(pattern, kind, score, seeds) of ``edges(pattern, value, kind, n)``.

    kind is -1 where the value is no seed. The graph is first cut down to the patterns that hold a
    seed and to their values. Hot patterns and hot values are summed up before they are shuffled;
    the joins are on plain keys and may be split.
    """
    seeded = (edges.filter("kind >= 0").groupBy("pattern", "kind")
              .agg(F.count("*").alias("seeds"))
              .groupBy("pattern")
              .agg(F.sum("seeds").alias("seeds"), F.max_by("kind", F.struct(
                  "seeds", -F.col("kind"))).alias("main")))
    graph = durable(edges.join(seeded.select("pattern"), "pattern"), "graph")
    scores = None
    for _ in range(rules.rounds):
        if scores is None:
            valued = graph.withColumn("worth", F.when(F.col("kind") >= 0, 1.0).otherwise(0.0))
        else:
            best = (graph.filter("kind < 0").join(scores, "pattern")
                    .groupBy("value").agg(F.max("score").alias("best")))
            valued = graph.join(best, "value", "left").withColumn(
                "worth", F.when(F.col("kind") >= 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))))
        scores = durable(valued.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("worth")) / F.sum("n")).alias("score")), "scores")
    return scores.join(seeded, "pattern").select("pattern", F.col("main").alias("kind"), "score",
                                                 "seeds")


def _trusted(edges: DataFrame, rules: Bootstrapping) -> DataFrame:
    return durable(pattern_scores(edges, rules).filter(
        (F.col("score") >= rules.min_score) & (F.col("seeds") >= rules.min_seeds)), "trusted")


def bootstrap(named: DataFrame, seeds: DataFrame, rules: Bootstrapping) -> DataFrame:
    """(k1, k2, a, b, kind): the discovered places, from ``seeds(pattern, value, kind, n)``.

    Each generation searches the texts for tokens in the patterns that have enough seeds since,
    scores the patterns searched, and searches for the values that joined; they take the smallest kind of
    their patterns. It ends when no value joins. Further seeds only raise scores, so the set of
    trusted patterns only grows.
    """
    spark = named.sparkSession
    places = spark.createDataFrame([], "k1 long, k2 long, a int, b int, value string, "
                                       "pattern string")
    totals = spark.createDataFrame([], "pattern string, total long")
    searched = spark.createDataFrame([], "pattern string")
    gained = spark.createDataFrame([], "value string, gained int")
    while True:
        kind = F.coalesce("gained", F.lit(-1)).alias("kind")
        counted = places.join(gained, "value", "left").groupBy("pattern", "value", kind).agg(
            F.count("*").alias("n"))
        edges = durable(seeds.unionByName(counted), "edges")
        enough = durable(
            edges.filter("kind >= 0").groupBy("pattern", "value").agg(F.sum("n").alias("n"))
            .groupBy("pattern").agg(F.count("*").alias("seeds"), F.sum("n").alias("n"))
            .filter(F.col("seeds") >= rules.min_seeds), "enough")
        unknown = enough.select("pattern").join(totals, "pattern", "left_anti")
        counts = [durable(_totals(named, block, rules), "totals")
                  for block in _in_blocks(unknown, rules)]
        totals = reduce(DataFrame.unionByName, counts, totals)
        share = F.col("n") / F.greatest("n", "total")
        fresh = durable(enough.join(totals, "pattern").filter(share >= rules.min_share)
                        .select("pattern").join(searched, "pattern", "left_anti"), "patterns")
        found = [_searched(named, block, [], rules) for block in _in_blocks(fresh, rules)]
        if found:
            searched = searched.unionByName(fresh)
            places = durable(reduce(DataFrame.unionByName, found, places).distinct(), "places")
            continue  # with all that stands in them
        edges = edges.join(searched, "pattern", "left_semi")
        trusted = _trusted(edges, rules)
        joined = durable(places.join(trusted.select("pattern", F.col("kind").alias("gained")),
                                     "pattern").groupBy("value").agg(
            F.min("gained").alias("gained")), "gained")
        new = durable(joined.join(gained.select("value"), "value", "left_anti").select("value"),
                      "values")
        found = [_searched(named, [], block, rules) for block in _in_blocks(new, rules)]
        if not found:
            return (places.join(trusted.select("pattern", "kind"), "pattern")
                    .groupBy("k1", "k2", "a", "b").agg(F.min("kind").alias("kind")))
        gained = joined
        places = durable(reduce(DataFrame.unionByName, found, places).distinct(), "places")


def extract(docs: DataFrame, rules: Bootstrapping = Bootstrapping()) -> DataFrame:
    """Base and discovered personal data of every whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base entities), base_sha256, spans (base and
    discovered, by kind and start), n_found (discovered). One row per row of ``docs``; rows equal
    in id and text give equal results and count once as an occurrence of what they hold. A null text
    is empty, an id may be null, other columns are ignored, and an empty table gives an empty one.
    Discovered spans never overlap base ones; of a place that patterns of several kinds surround
    the smallest kind counts.
    """
    named = _named(docs)
    found = durable(_found(named, rules), "entities")
    seeds = (found.filter(F.size("seeds") > 0).dropDuplicates(["k1", "k2"])
             .select(F.explode("seeds").alias("s"))
             .select(F.explode("s.patterns").alias("pattern"), "s.value", "s.kind")
             .groupBy("pattern", "value", "kind").agg(F.count("*").alias("n")))
    extra = (bootstrap(named, durable(seeds, "seeds"), rules).groupBy("k1", "k2")
             .agg(F.collect_list(F.struct("kind", "a", "b")).alias("extra")))
    joined = found.join(extra, ["k1", "k2"], "left")
    every = F.array_sort(F.concat("spans", F.coalesce("extra", F.expr(
        "cast(array() as array<struct<kind:int,a:int,b:int>>)"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform(every, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["a"].cast("string"), s["b"].cast("string"))), ",")
    def of_kind(k: int):  # one argument: a second one would be the element's index
        return lambda s: s["kind"] == k

    counts = [F.size(F.filter("spans", of_kind(k))).cast("long")
              .alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return joined.select("doc_id", *counts, "base_sha256", text.alias("spans"),
                         F.greatest(F.size("extra"), F.lit(0)).cast("long").alias("n_found"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/documents.parquet"))
