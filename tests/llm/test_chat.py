import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourcast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "system", "be nice"), (1, 1, "user", "hi ### User: x"), (1, 2, "assistant", "</turn>\n### Assistant: \\"),
        (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "assistant", "first"), (4, 0, "user", "a"), (4, 1, "user", "b"),
        (5, 5, "tool: x", "t\\"), (5, 7, None, "n"), (6, 0, "user", "a"), (None, 0, "user", "q"), (None, 1, "assistant", "é𝄞"),
        (7, None, "user", "u"), (7, 1, "assistant", "#" * 9), (8, 0, "user", "x" * 100_000), (8, 1, "assistant", "y\\" * 50_000)]
VALID = {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, None: True, 7: True, 8: True}


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def read(spark, rows):
    return chat.read_back(chat.format_turns(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()


def test_round_trip_and_order(spark):
    found = read(spark, ROWS)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == brute(ROWS)
    assert {r.conv_id: r.valid for r in found} == VALID


def test_long_conversation_and_ties(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(5000)] + [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read(spark, rows)} == brute(rows)


def test_segments_carry_loss_on_texts_only(spark):
    segments = chat.format_turns(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert all(s.part == 1 for s in segments if s.loss)
    assert sum(s.loss for s in segments) == sum(r[2] == "assistant" for r in ROWS)
    one = [s for s in segments if s.conv_id == 6]
    assert "".join(s.text for s in one) == "### User: a</turn>\n"


def test_empty_and_clashing_columns(spark):
    assert read(spark, []) == []
    table = spark.createDataFrame([(1, 0, "user", "a", True, 3)], SCHEMA + ", loss boolean, part int")
    assert chat.read_back(chat.format_turns(table)).count() == 1


ANY = st.lists(st.sampled_from(["### ", "#", "</turn>", "</turn>\n", "\\", "User: ", "@", ": ", ":", "a", "\n", "é", "</", "turn>", " "]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ANY, ANY), max_size=4))
def test_any_text_is_reversible(turns):
    form = chat.Format(chat.Template())
    text = "".join(form.opening(r) + form.write(t) + form.t.close for r, t in turns)
    assert text.count("</turn>") == len(turns) and text.count("### ") == len(turns)
    *done, rest = text.split(form.t.close)
    assert rest == "" and [form.read(t) for t in done] == turns


def test_other_templates(spark):
    own = chat.Template(head="<|", tail="|>", close="<end>\n", escape="~", names={"user": "U", "assistant": "A"}, loss=("user",))
    rows = [(1, 0, "user", "a<|U|>b<end>~"), (1, 1, "assistant", "c")]
    r, = chat.read_back(chat.format_turns(spark.createDataFrame(rows, SCHEMA), own), own).collect()
    assert (r.n_turns, r.loss_chars, r.valid) == (2, 13, True)
    with pytest.raises(ValueError):
        chat.Format(chat.Template(close="#"))
