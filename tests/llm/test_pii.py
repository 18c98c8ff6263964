"""Base entities against the plain regular expressions; what contexts discover."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


ALPHABET = st.text(alphabet="ab_@.-+ ()0123456789\né٣", max_size=60)


@settings(max_examples=1500, deadline=None)
@given(ALPHABET)
def test_base_spans_equal_the_expressions(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_usual_forms():
    text = ("Mail a.b+c@x-y.example.org, c@d or x@y.z@u.vw; 10.0.0.255 256.1.1.1 1.2.3.4.5.6.7.8; "
            "4111 1111-1111 1111, 4111111111111112; +1 (988) 555-2485 +12 34")
    assert pii.base_spans(text) == plain(text)
    assert [k for k, _, _ in plain(text)] == [0, 0, 1, 1, 1, 2, 3]
    assert pii.base_spans("9" * 200_000) == [] and pii.base_spans("a" * 200_000) == []


def test_contexts_discover_unseen_identifiers(spark):
    # ten seeds after the same two words; an obfuscated address follows them as well
    rows = [(i, f"please contact agent user{i}@mail.example.com today") for i in range(10)]
    rows += [(50, "please contact agent jane4(at)mail,example today"),
             (51, "the room number is 123456 here"), (52, None), (52, ""), (None, "x"),
             (1, rows[1][1])]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, spans string")
    out = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert pii.extract(docs).count() == len(rows)
    assert out[3].n_email == 1 and out[3].spans == "email:21:43"
    assert out[3].base_sha256 == hashlib.sha256(b"email:21:43").hexdigest()
    assert out[50].n_found == 1 and out[50].spans.startswith("email:21:")
    assert out[50].n_email == 0 and out[50].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert out[51].spans == "" and out[52].spans == "" and out[None].n_found == 0
    assert pii.extract(docs.limit(0)).count() == 0


def test_discovered_values_seed_further_patterns(spark):
    # six identifiers share a context with addresses and another with a seventh, which has no other
    rows = [(i, f"please contact agent user{i}@mail.example.com today") for i in range(60)]
    rows += [(100 + i, f"please contact agent ref-7700{i} today") for i in range(6)]
    rows += [(200 + i, f"open ticket number ref-7700{i} again") for i in range(6)]
    rows += [(300, "open ticket number ref-88001 again"), (301, "the room number is 123456 here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert all(out[k + i].n_found == 1 for k in (100, 200) for i in range(6))
    assert out[300].spans == "email:19:28" and out[300].n_email == 0
    assert out[301].n_found == 0 and all(out[i].n_found == 0 for i in range(60))


def test_identifiers_of_any_form_are_found(spark):
    """Letters only, five characters, an obfuscated address, quotes around: the context decides.
    What is written like a card and fails its check is none, and numbers elsewhere are left."""
    rows = [(i, f"please contact agent user{i}@mail.example.com today") for i in range(200)]
    rows += [(500, "please contact agent jane(at)mail.example today"),
             (501, "please contact agent marlowe today"), (502, "please contact agent q7x-2 today"),
             (503, 'please contact agent "smith" today'),
             (504, "please contact agent 4111111111111112 today"),
             (505, "please contact agent 256.1.1.1 today"),
             (506, "the room number is 123456 here, call 4111 1111 1111 1112 or agent today"),
             (507, "agent marlowe left"), (508, "marlowe")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert out[500].spans == "email:21:41" and out[501].spans == "email:21:28"
    assert out[502].spans == "email:21:26" and out[503].spans == "email:22:27"
    assert [out[i].n_found for i in (504, 505, 506)] == [0, 0, 0]
    assert not any(out[i].n_found for i in range(200))
    blocks = {r.doc_id: r for r in pii.extract(docs, pii.Bootstrapping(block=1)).collect()}
    assert blocks == out


def test_common_words_in_a_context_lower_its_score(spark):
    """A context that mostly holds other words is not trusted, whatever seeds it has."""
    rows = [(i, f"write to user{i}@mail.example.com or") for i in range(20)]
    rows += [(100 + i, f"write to {w} or") for i, w in enumerate(["him", "her", "them", "us"] * 5)]
    out = pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.filter("n_found > 0").count() == 0


def plain_scores(edges, rounds):
    """{pattern: score} by the definition: a pattern is the mean of its instances, an instance the
    best of its patterns, seeds are 1."""
    seeded = {p for p, v, k, n in edges if k >= 0}
    edges = [e for e in edges if e[0] in seeded]
    best = {}
    for _ in range(rounds):
        score = {}
        for p in seeded:
            own = [(n, 1.0 if k >= 0 else best.get(v, 0.0)) for q, v, k, n in edges if q == p]
            score[p] = sum(n * w for n, w in own) / sum(n for n, _ in own)
        for p, v, k, n in edges:
            if k < 0:
                best[v] = max(score[q] for q, w, _, _ in edges if w == v and _ is not None)
    return score


def test_scores_equal_plain(spark):
    import random

    r = random.Random(9)
    seeds = {f"v{i}": r.choice([0, 0, 2]) for i in range(6)}
    edges = {}
    for _ in range(120):
        p, v = f"p{r.randrange(15)}", f"v{r.randrange(25)}"
        edges[p, v] = (p, v, seeds.get(v, -1), r.randrange(1, 5))
    rows = list(edges.values())
    df = spark.createDataFrame(rows, "pattern string, value string, kind int, n long")
    for rounds in (1, 2, 3):
        out = {x.pattern: x for x in pii.pattern_scores(df, pii.Bootstrapping(rounds=rounds)).collect()}
        expected = plain_scores(rows, rounds)
        assert set(out) == set(expected)
        assert all(abs(out[p].score - s) < 1e-12 for p, s in expected.items())
        for p, x in out.items():
            kinds = [k for q, _, k, _ in rows if q == p and k >= 0]
            assert x.seeds == len(kinds)
            assert x.kind == min(set(kinds), key=lambda k: (-kinds.count(k), k))


def test_very_long_texts_and_repeated_rows(spark):
    context = "please contact agent {} today "
    long = "word " * 100_000 + context.format("someone.else") + "filler " * 50_000
    rows = [(i, context.format(f"user{i}@mail.example.com")) for i in range(30)]
    rows += [(90, long), (90, long), (91, context.format("10.0.0.7"))]
    out = pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 33
    copies = [r for r in out if r.doc_id == 90]
    assert copies[0] == copies[1] and copies[0].spans == f"email:{500_000 + 21}:{500_000 + 33}"


def test_counted_contexts_equal_the_patterns_of_tokens():
    """Word by word as token by token."""
    import random
    from collections import Counter

    r = random.Random(4)
    words = ["call", "me", '"at"', "x@y.zz", "99", "a-1", "Bob.", "...", "w" * 100, "(the"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(30))) for _ in range(200)]
    every = Counter(p for t in texts for m in pii._TOKEN.finditer(t)
                    for p in ([] if not m[0].strip(pii._EDGE) or len(m[0]) > 80 else pii._patterns(
                        t, m.end() - len(m[0].lstrip(pii._EDGE)),
                        m.start() + len(m[0].rstrip(pii._EDGE)), 80)))
    some = r.sample(sorted(every), len(every) // 2)
    total, contexts = Counter(), pii._Contexts(some, 80)
    for t in texts:
        total.update(p for _, p in contexts.hits(t, contexts.words(t)))
    assert dict(total) == {p: every[p] for p in some}


def test_counts_are_by_kind_whatever_the_order_of_spans(spark):
    texts = ["ip 10.0.0.1 card 4111 1111 1111 1111", "+49 30 1234 5678 and a@b.cc, 1.2.3.4",
             None, "x@y.org"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone)
           for r in pii.extract(docs).collect()}
    for i, text in enumerate(texts):
        spans = plain(text or "")
        assert got[i] == tuple(sum(k == kind for k, _, _ in spans) for kind in range(4))
