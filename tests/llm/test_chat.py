import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import chat as C

PIECES = [*C.CONTROL, "\\", "<", ">", "s>", "/s>", "[", "INST]", "a", " ", "\n", "é", "<\\s>", "<<", "SYS>>", "|role|>", "中", "\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16")]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_hides_controls(text):
    hidden = C.escape(text)
    assert C.unescape(hidden) == text
    assert not any(s in hidden for s in C.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]), TEXT), max_size=5))
def test_round_trip(turns):
    codec = C.Codec()
    ids, mask = [], []
    for role, text in turns:
        one = codec.turn(role, text)
        ids += one
        mask += C.loss_mask(np.array(one)).tolist()
    assert mask == C.loss_mask(np.array(ids, dtype=np.int64)).tolist()
    assert [(r, t) for r, t, _ in C.read_back(ids, mask, codec)] == turns
    assert [on for _, _, on in C.read_back(ids, mask, codec)] == [r == "assistant" for r, _ in turns]


def test_contract(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    convs = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in rows:
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in C.op5_chat_format(spark, data).collect()}
    assert set(got) == set(convs)
    for k, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[k].n_turns == len(turns)
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[k].formatted_chars > sum(len(t) for _, _, t in turns)


def test_awkward(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (2, 0, "user", "a" * 200_000), (2, 0, "user", "a" * 200_000), (3, None, "tool", "t")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, token_ids string")
    got = {r.conv_id: r for r in C.digest(C.format_turns(df)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, None: 2, 2: 2, 3: 1}
    assert got[None].loss_chars == 1 and got[1].loss_chars == 0
    assert C.digest(C.format_turns(df.limit(0))).count() == 0


def test_long_runs(spark):
    """Runs that tokenisers recurse over, and many marks in one text."""
    codec = C.Codec()
    for text in (" " * 1_000_000, "a" * 300_000, "\n" * 50_000 + " x", "</s>" * 40_000, "[INST]\\ " * 20_000):
        hidden = C.escape(text)
        assert C.unescape(hidden) == text and codec.decode(codec.encode(text)) == text
    df = spark.createDataFrame([(1, 0, "user", " " * 1_000_000), (1, 1, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    r = C.digest(C.format_turns(df)).first()
    assert (r.n_turns, r.turns_sha256) == (2, hashlib.sha256(f"user\n{' ' * 1_000_000}\nassistant\nok\n".encode()).hexdigest())


def test_large_ids_beside_null(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(big, None, "user", "x"), (None, 2**61 + 1, "user", "y"), (big, 3, "assistant", "z")], "conv_id long, turn long, role string, text string").coalesce(1)
    assert {r.conv_id: r.n_turns for r in C.digest(C.format_turns(df)).collect()} == {big: 2, None: 1}
    assert {r.turn for r in C.format_turns(df).collect()} == {None, 2**61 + 1, 3}
