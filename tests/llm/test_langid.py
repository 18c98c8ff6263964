"""Compression classification: against a plain loop, held-out accuracy, odd rows."""

import random

import zstandard

from marginflow.llm.langid import UNKNOWN, Compression, held_out, identify, learn, tied

WORDS = {"aa": "the and of river house garden with tree water stone",
         "bb": "und der die haus mit baum wasser stein nicht garten",
         "cc": "les des une maison avec arbre eau pierre jardin dans"}


def texts(seed, n):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randrange(8, 60))), lang)
            for i, lang in enumerate(r.choice(sorted(WORDS)) for _ in range(n))]


def plain(text, model, rules):
    """(language, margin) by compressing every piece with every dictionary."""
    raw = text.lower().encode()
    sizes = {}
    for name in sorted(model):
        d = zstandard.ZstdCompressionDict(model[name].encode(),
                                          dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tool = zstandard.ZstdCompressor(level=rules.level, dict_data=d, write_checksum=False,
                                        write_content_size=False, write_dict_id=False)
        sizes[name] = sum(len(tool.compress(raw[i:i + rules.piece_bytes]))
                          for i in range(0, len(raw), rules.piece_bytes))
    best = min(sizes, key=lambda k: (sizes[k], k))
    second = min(v for k, v in sizes.items() if k != best)
    return best, (second - sizes[best]) / second


def test_equals_plain_and_predicts_unseen(spark):
    rows = texts(1, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rules = Compression()
    model = learn(docs.filter(~held_out()), rules)
    assert set(model) == set(WORDS)
    out = identify(docs, model, rules).withColumn("held_out", held_out()).collect()
    by_id = {i: (t, lang) for i, t, lang in rows}
    for r in out:
        name, margin = plain(by_id[r.doc_id][0], model, rules)
        assert r.lang_pred == name and abs(r.margin - margin) < 1e-12
        assert r.rejected == (margin < rules.min_margin) and 0 <= r.score <= 1
    unseen = [r for r in out if r.held_out]
    assert sum(r.lang_pred == by_id[r.doc_id][1] for r in unseen) >= 0.97 * len(unseen)


def test_learning_is_bounded_and_deterministic(spark):
    docs = spark.createDataFrame(texts(2, 200) + [(900, None, "aa"), (901, "1 2 3", "dd"),
                                                  (902, "word", None)],
                                 "doc_id long, text string, lang string")
    rules = Compression(dictionary_chars=1000, sample_chars=100, model_chars=2100)
    model = learn(docs, rules)  # every language with letters, an equal share for each
    assert set(model) == set(WORDS) and all(500 < len(t) <= 710 for t in model.values())
    assert model == learn(docs.repartition(7), rules)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 34 !!", "x"), (None, WORDS["aa"], "x"),
         (4, "the river " * 20000, "x"), (4, "the river " * 20000, "x")],
        "doc_id long, text string, lang_pred string")
    model = {"aa": WORDS["aa"] * 20, "bb": WORDS["bb"] * 20}
    out = sorted(((r.doc_id or 0, r.lang_pred, r.rejected) for r in identify(docs, model).collect()))
    assert out == [(0, "aa", False), (1, UNKNOWN, True), (2, UNKNOWN, True), (3, UNKNOWN, True),
                   (4, "aa", False), (4, "aa", False)]
    assert {r.lang_pred for r in identify(docs, {}).collect()} == {UNKNOWN}
    assert identify(docs.limit(0), model).count() == 0
    assert learn(docs.limit(0).withColumn("lang", docs["lang_pred"])) == {}


def test_short_texts_are_told_apart(spark):
    # zstandard stores a few bytes as they are, in one size under every dictionary
    model = {name: "\n".join(t for _, t, lang in texts(3, 200) if lang == name) for name in WORDS}
    rows = [(1, "House.", "aa"), (2, "Baum.", "bb"), (3, "Jardin.", "cc"), (4, "Q.", "aa")]
    for _, text, _ in rows:
        assert plain(text, model, Compression())[1] == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = identify(docs, model)
    out = {r.doc_id: r for r in judged.withColumn("tied", tied(judged)).collect()}
    assert [out[i].lang_pred for i, _, _ in rows] == [lang for _, _, lang in rows]
    assert [out[i].rejected for i in (1, 2, 3, 4)] == [False, False, False, True]
    assert [out[i].tied for i in (1, 2, 3, 4)] == [False, False, False, True]


def test_any_part_of_a_text_may_teach(spark):
    rows = [(1, "1 " * 5000 + WORDS["aa"], "aa"), (2, WORDS["bb"] + " 2" * 5000, "bb"),
            (3, ("." * 50 + "un deux trois " * 3) * 40, "cc"), (4, "9" * 5000, "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(docs, Compression(sample_chars=60))
    assert set(model) == {"aa", "bb", "cc"}
    assert all(any(c.isalpha() for c in text) for text in model.values())


def test_many_languages_are_all_learned(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "concat('word', id, ' and more') AS text",
                                       "concat('l', id % 300) AS lang")
    assert len(learn(docs)) == 300
