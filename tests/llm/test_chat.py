"""Windows against a plain reading of the conversations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from airsight.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string"
PIECES = ["word ", "</s>", "[INST]", "\\", "\\n", "\n", "<|turn|>", "<|end|>\n", "é😀 ", "<", "|", "<\\|", "[/INST] "]


def tables():
    rng = random.Random(8)
    rows = []
    for c in range(40):
        n = rng.choice([1, 2, 5, 60])
        for t in range(n):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "tool\nx", None])
            text = rng.choice([None, "", "".join(rng.choices(PIECES, k=rng.choice([3, 30, 200])))])
            rows.append((c * 7, t, role, text, "x"))
    rows += [(None, 1, "assistant", "b", "x"), (None, 0, "user", "a", "x"), (900, 0, "assistant", "same", "x"), (900, 0, "assistant", "same", "x"), (901, None, "user", "u", "x")]
    return rows


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:4] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        texts = [(role or "", text or "") for _, role, text in turns]
        loss = "".join(t for r, t in texts if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in texts)
        out[c] = (len(texts), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("together", [True, False])
def test_everything_comes_back(spark, together):
    rows = tables()
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(6), budget=120, history=40)
    back = chat.read_back(windows if together else windows.orderBy(F.rand(3)), together).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in back} == expected(rows) and len(back) == len(expected(rows))


def test_windows_keep_their_limits(spark):
    rows = tables()
    turns = {}
    for r in sorted((r for r in rows if r[0] is not None and r[0] < 900), key=lambda r: r[:2]):
        turns.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), budget=120, history=40).collect()
    several = 0
    for w in sorted((w for w in windows if w["conv_id"] in turns), key=lambda w: (w["conv_id"], w["window"])):
        mine, said = turns[w["conv_id"]], chat.parse(w["text"])
        first, n, repeated = w["first_turn"], w["n_turns"], w["repeated"]
        assert said[repeated:] == mine[first : first + n] and n >= 1
        system = 1 if mine[0][0] == "system" else 0
        if w["window"]:
            several += 1
            assert said[:system] == mine[:system] and said[system:repeated] == mine[first - (repeated - system) : first]
        else:
            assert repeated == 0
        assert w["n_tokens"] <= 120 or n == 1 or (w["window"] == 0 and n <= 1 + system)
        for body in (b for _, b in said):
            assert chat.unescape(chat.escape(body)) == body and not any(c in chat.escape(body) for c in chat.CONTROL)
        assert [chat.unescape(w["text"][s["start"] : s["stop"]]) for s in w["loss"]] == [t for r, t in said[repeated:] if r == "assistant"]
    assert several > 20


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_reads_back_every_conversation(spark):
    from airsight.llm.queries import op2_chat_windows

    rows = [tuple(r) + ("",) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    want = expected(rows + [(-1, 0, "user", said, ""), (-1, 1, "assistant", said, "")])
    back = op2_chat_windows(spark, "/root/testdata/sf0.001").collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in back} == want
