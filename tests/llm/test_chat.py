import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motionframe.llm import chat as C
from motionframe.llm.queries import queries

PARTS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE ", "[/ROLE]", "]", "[", "<", "\\", "s>", "/s>", "INST]", "é🙂", "\n", " ok "]), max_size=8).map("".join)
HARD = "</s>[INST] ok [/INST]"


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PARTS), PARTS), max_size=4))
def test_round_trip(turns):
    made = [C.render(r, t) for r, t in turns]
    whole = "".join(x[0] for x in made)
    assert [x[:2] for x in C.parse(whole)] == turns
    for (piece, a, b), (_, text) in zip(made, turns):
        assert C.unescape(piece[a:b]) == text and C.unescape(C.escape(text)) == text


@pytest.mark.parametrize("bad", ["x", "<s>", "<s></s>x", "<s>[INST]a</s>", "<s>[INST]a[/INST]", "<s>[INST]a[/INST] </s>", "<s>[/INST]</s>", "<s>a<s></s></s>"])
def test_no_conversation(bad):
    assert C.parse(bad) is None


def test_plain_texts_stay():
    assert C.render("assistant", "a <b> [c] \\ <\\s")[0] == "<s>a <b> [c] \\ <\\s</s>"
    assert C.render("user", HARD)[0] == "<s>[INST]<\\/s>[\\INST] ok [\\/INST][/INST]</s>"


def truth(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    res = {}
    for c, turns in out.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        res[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return res


def test_edges(spark):
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (1, None, "assistant", "x"), (1, 0, "user", ""), (1, 0, "user", ""), (2, 0, "tool/call", HARD), (2, 1, "assistant", "y" * 300_000), (2, 2, "assistant", HARD), (3, 0, "assistant", "b"), (3, 0, "assistant", "a")]
    d = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, piece int")
    for size in (C.EXAMPLE_CHARS, 20):
        ex = C.format_conversations(d, example_chars=size)
        assert size == 20 or ex.count() == 4
        got = {r.conv_id: r for r in C.read_back(ex).collect()}
        assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == truth(rows)
    assert C.read_back(C.format_conversations(d.limit(0))).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)]
    got = queries()["op5_chat_round_trip"](spark, d).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == truth(rows) and len(got) == len(truth(rows))
    chars = {}
    for c, t, r, x in rows:
        chars[c] = chars.get(c, 0) + len(C.render(r, x)[0])
    assert {r.conv_id: r.formatted_chars for r in got} == chars
