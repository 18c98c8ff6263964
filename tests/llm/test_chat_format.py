"""Chat formatting: reversible escapes, spans against the template itself, rewritten history,
long conversations, plain digests, odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm.chat_format import (CHATML, HOSTILE, INSTRUCT, LAST_THOUGHT, Formatting,
                                        Rendering, Template, format_turns, op11_chat_format,
                                        read_back)

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\/s>", "[SEP] ", "[", "<", "s>", "é", " ",
        "<|im_end|>", "<\\\\|im_start|>", "\n", "ok", ""]
texts = st.lists(st.sampled_from(BITS), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escapes_are_reversible(text):
    for template in (INSTRUCT, CHATML):
        safe = template.escaper()(text)
        assert not any(c in safe for c in template.controls)
        assert template.unescaper()(safe) == text


def test_controls_that_overlap_are_refused():
    for controls in (("<<a>",), ("<a", "a<"), ("x",), ("<\\a",)):
        with pytest.raises(ValueError):
            Template(CHATML.render, CHATML.parse, controls)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "</s>x"]),
                          texts), max_size=12))
def test_spans_and_parse(turns):
    rules = Formatting(stretch=5, context=2)
    escape, back = INSTRUCT.escaper(), INSTRUCT.unescaper()
    state, whole = Rendering(INSTRUCT, rules), ""
    for k, (role, text) in enumerate(turns):
        piece, start, end, a, b, rewrites = state.append((escape(role), escape(text)))
        whole = whole[:start] + piece
        expected = INSTRUCT.render([(escape(r), escape(t)) for r, t in turns[:k + 1]])
        assert whole == expected and end == len(whole) and not rewrites
        assert whole[a:b] == escape(text) and len(state.turns) <= 5
    assert [(back(r), back(t)) for r, t in INSTRUCT.parse(whole)] == turns


def test_rewritten_history_is_found():
    turns = [("user", "q"), ("assistant", "<think>why</think>\n\nbecause"), ("user", "r"),
             ("assistant", "<think>x</think>y"), ("user", "s")]
    state, whole, seen = Rendering(LAST_THOUGHT, Formatting()), "", []
    for k, turn in enumerate(turns):
        piece, start, end, a, b, rewrites = state.append(turn)
        whole = whole[:start] + piece
        seen.append(rewrites)
        assert whole == LAST_THOUGHT.render(turns[:k + 1]) and whole[a:b] == turn[1]
    assert seen == [False, False, True, False, True]
    # a mark that follows the last turn only is taken away by each new one
    closing = Template(lambda t: CHATML.render(t) + "<|end|>", CHATML.parse, ())
    state = Rendering(closing, Formatting())
    assert [state.append(t)[-1] for t in turns[:3]] == [False, True, True]


def test_templates_that_move_or_hide_texts():
    twice = Template(lambda t: "".join(f"{x}|{x}\n" for _, x in t), lambda s: [], ())
    assert Rendering(twice, Formatting()).append(("user", "abc"))[3:5] == (None, None)
    trimmed = Template(lambda t: "".join(f"<{x.strip()}>" for _, x in t), lambda s: [], ())
    assert Rendering(trimmed, Formatting()).append(("user", " a "))[1:5] == (0, 3, 1, 2)


def test_numbered_turns_are_never_cut_short():
    numbered = Template(lambda t: "".join(f"{i}:{x}\n" for i, (_, x) in enumerate(t)),
                        lambda s: [], ())
    state, whole = Rendering(numbered, Formatting(stretch=4, context=2)), ""
    turns = [("user", f"t{i}") for i in range(30)]
    for turn in turns:
        piece, start, *_ = state.append(turn)
        whole = whole[:start] + piece
    assert whole == numbered.render(turns)


def test_late_changes_of_early_turns_are_seen(spark):
    """Every prefix is rendered whole: a template that touches its third turn once there are a
    hundred is caught at that turn, however long the conversation was before."""
    late = Template(lambda t: "".join(
        f"{'~' if i == 2 and len(t) >= 100 else ''}{x}\n" for i, (_, x) in enumerate(t)),
        lambda s: [("user", x) for x in s.splitlines()], ())
    turns = [("user", f"t{i}") for i in range(130)]
    state, whole, seen = Rendering(late, Formatting()), "", []
    for k, turn in enumerate(turns):
        piece, start, *_, rewrites = state.append(turn)
        whole = whole[:start] + piece
        assert whole == late.render(turns[:k + 1])
        seen += [k] * rewrites
    assert seen == [99]
    rows = spark.createDataFrame([(1, i, *turn) for i, turn in enumerate(turns)], SCHEMA)
    pieces = format_turns(rows, late)
    assert [x.position for x in pieces.filter("rewrites").collect()] == [99]
    assert read_back(pieces, late).first().rewritten


def test_digests(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", None]),
             r.choice([None, "", HOSTILE, "".join(r.choices(BITS, k=6))]))
            for c in [1, 2, 3, None, -7] for t in range(r.randrange(1, 9))]
    rows += [(50, t, "assistant", f"answer {t} </s>") for t in range(700)]  # beyond the stretch
    rows += [(60, 1, "user", "b"), (60, 1, "user", "a"), (60, 1, "user", "a"), (60, None, "user", "c")]
    turns = spark.createDataFrame(r.sample(rows, len(rows)), SCHEMA).selectExpr(
        "*", "1 AS piece", "2 AS position")
    pieces = format_turns(turns)
    out = {x.conv_id: x for x in read_back(pieces).collect()}
    assert set(out) == {x[0] for x in rows}
    for conv, row in out.items():
        own = sorted(((t is not None, t or 0, a or "", b or "") for c, t, a, b in rows if c == conv))
        said = [b for *_, a, b in own if a == "assistant"]
        plain = "".join(f"{a}\n{b}\n" for *_, a, b in own)
        escape = INSTRUCT.escaper()
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert row.loss_chars == sum(map(len, said))
        assert row.loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
        assert row.formatted_chars == len(INSTRUCT.render([(escape(a), escape(b))
                                                           for *_, a, b in own]))
    listed = pieces.filter("conv_id = 60").orderBy("position").collect()
    assert "".join(x.piece for x in listed) == "<s>[INST] c [/INST][INST] a [/INST][INST] a [/INST][INST] b [/INST]"
    assert format_turns(turns.limit(0)).count() == 0 and read_back(pieces.limit(0)).count() == 0


def test_rewritten_conversations_have_no_digest(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "<think>w</think>a"), (1, 2, "user", "r"),
            (2, 0, "user", "q")]
    pieces = format_turns(spark.createDataFrame(rows, SCHEMA), LAST_THOUGHT)
    out = {x.conv_id: x for x in read_back(pieces, LAST_THOUGHT).collect()}
    assert out[1].rewritten and out[1].turns_sha256 is None and not out[2].rewritten
    chars = len(LAST_THOUGHT.render([x[2:] for x in rows[:3]]))
    assert out[1].formatted_chars == chars


def test_query_adds_the_hostile_conversation(spark, tmp_path):
    long = "word " * 200_000
    spark.createDataFrame([(3, 0, "assistant", long)], SCHEMA).write.parquet(
        f"{tmp_path}/conversations.parquet")
    out = {x.conv_id: x for x in op11_chat_format(spark, str(tmp_path)).collect()}
    assert out[3].loss_chars == len(long) and set(out) == {-1, 3}
    said = f"user\n{HOSTILE}\nassistant\n{HOSTILE}\n"
    assert out[-1].n_turns == 2 and out[-1].loss_chars == len(HOSTILE)
    assert out[-1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
