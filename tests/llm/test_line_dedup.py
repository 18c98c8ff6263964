"""Line dedup against all pairs in plain Python."""

import random
import re

from marginflow.llm.line_dedup import Lines, dedup_lines, repeated_lines


def near(x, y):
    """Edit distance of at most one word."""
    if abs(len(x) - len(y)) > 1:
        return False
    k = 0
    while k < min(len(x), len(y)) and x[k] == y[k]:
        k += 1
    return x == y or x[k + (len(x) >= len(y)):] == y[k + (len(y) >= len(x)):]


def plain(rows, rules=Lines()):
    lines = []
    for i, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n"), 1):
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line))
            if w:
                lines.append((i, k, w))
    gone = set()
    for b, (i, k, w) in enumerate(lines):
        for _, _, v in lines[:b]:
            if w == v or min(len(w), len(v)) >= rules.edit_words and near(v, w):
                gone.add((i, k))
    return gone


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bases = [[r.choice(words) for _ in range(r.choice([3, 5, 7, 8, 9, 20]))] for _ in range(25)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(r.randrange(8)):
            line = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randrange(len(line))
                line[at:at + r.randrange(2)] = [r.choice(words)] * r.randrange(2)
            text.append(r.choice(["", " ", "\t"]) + r.choice([" ", "  "]).join(line))
            if r.random() < 0.2:
                text.append("")
        rows.append((i, "\n".join(text)))
    return rows


def test_equals_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed) + [(100, None), (101, ""), (102, "\n\n"), (103, "é ü ö a b c d e\r\n")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert {(r.doc_id, r.line) for r in repeated_lines(docs).collect()} == plain(rows)


def test_texts_and_odd_rows(spark):
    line = "one two three four five six seven eight"
    rows = [(1, f"{line}\nshort\nshort", 1), (2, f"Two\n{line} nine\n", 2), (2, f"Two\n{line} nine\n", 2),
            (3, None, 3), (None, line, 4), (4, line.upper(), 5), (5, " ".join(["x"] * 20000), 6),
            (6, " ".join(["x"] * 19999), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "line", "n_lines", "n_removed"]
    got = sorted(((r.line, r.doc_id, r.text if r.line < 6 else None, r.n_lines, r.n_removed)
                  for r in out.collect()))
    assert got == [(1, 1, f"{line}\nshort", 3, 1), (2, 2, "Two\n", 3, 1), (2, 2, "Two\n", 3, 1),
                   (3, 3, None, 0, 0), (4, None, line, 1, 0), (5, 4, "", 1, 1),
                   (6, 5, None, 1, 0), (7, 6, None, 1, 1)]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_short_lines_and_equal_sums(spark):
    """Lines of a word or two are compared as well. The words x and y in the order of bit parities
    and the opposite order have equal polynomials modulo 2^64; they are no copies."""
    parity = [bin(i).count("1") % 2 for i in range(2048)]
    line, other = (" ".join("xy"[p ^ flip] for p in parity) for flip in (0, 1))
    word, reverse = line.replace(" ", ""), other.replace(" ", "")
    rows = [(1, f"All rights reserved.\n{line}\n{word}"), (2, f"all RIGHTS reserved.\n{other}\n{reverse}"),
            (3, f"{line} x\nOk"), (4, f"ok\n{other} y z"), (5, f"y {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in repeated_lines(docs).collect()} == {
        (2, 1), (3, 1), (4, 1), (5, 1)} == plain(rows)
