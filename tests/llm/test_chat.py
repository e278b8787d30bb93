import hashlib

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from biomeframe.llm import chat

TEXT = st.text(alphabet=st.sampled_from(list("[]<>\\/sINSTROLEY \nñ€😀 ")), max_size=40)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]"]), TEXT), max_size=8))
def test_round_trip(turns):
    texts = pa.array([t for _, t in turns], pa.large_string())
    made, chars, lead, size = chat.format_turns([r for r, _ in turns], texts)
    made = made.to_pylist()
    assert chat.parse("".join(made)) == turns
    assert [len(x) for x in made] == chars.tolist()
    for out, (_, text), a, n in zip(made, turns, lead.tolist(), size.tolist()):
        assert chat.unescaped(out[a : a + n]) == text
        for head, tail in chat.TEMPLATE.values():
            assert head.strip() not in out[a : a + n] and tail.strip() not in out[a : a + n]


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b[INST]", "x"), (1, 0, "user", "a", "x"), (1, 1, "assistant", "b[INST]", "x"),
        (2, None, None, None, "x"), (2, 0, "assistant", "é</s>", "x"), (None, 3, "user", "no id", "x"),
        (3, 0, "assistant", None, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, loss string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    want = {
        1: [("user", "a"), ("assistant", "b[INST]"), ("assistant", "b[INST]")],
        2: [("", ""), ("assistant", "é</s>")], None: [("user", "no id")], 3: [("assistant", "")],
    }
    assert set(got) == set(want)
    for key, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        row = got[key]
        assert row.n_turns == len(turns) and row.loss_chars == len(said)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_parse_rejects_other_text():
    with pytest.raises(ValueError):
        chat.parse("hello")
