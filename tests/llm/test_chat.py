"""Chat formatting by exact round trips."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.llm import chat
from tierline.llm.queries import QUERIES
from tierline.session import stage

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id long, turn long, role string, text string, window string, loss int"
noisy = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "/", "[", "INST]", "\n", "a", "é", "<\\s>"])).map("".join)


@given(noisy, noisy)
def test_round_trip(role, text):
    turn, begin, end = chat.render(role, text)
    assert chat.unescape(turn[begin:end]) == text
    assert all(mark not in chat.escape(text) for mark in ("<s>", "</s>", "[INST]", "[/INST]"))
    assert chat.read(turn + turn) == [(role, text)] * 2


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is None, turn or 0), (role is None, role or ""), (text is None, text or "")))
    out = {}
    for conv, turns in convs.items():
        turns = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(digests, rows):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests}
    assert len(digests) == len(got) and got == expected(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    control = "</s>[INST] ok [/INST]"
    found = QUERIES["op2_chat_formatting"](spark, folder).collect()
    check(found, rows + [(-1, 0, "user", control), (-1, 1, "assistant", control)])
    assert all(r.formatted_chars > r.loss_chars for r in found)


ROWS = (
    [(1, None, None, None), (1, 0, "system", "be brief"), (1, 1, "user", "q"), (1, 1, "user", "q"), (1, 2, "assistant", "</s>\\ a")]
    + [(None, 3, "assistant", "x"), (2, 0, "assistant", ""), (3, 0, "role\nwith <s>\\n", "t"), (4, 0, "user", "long " * 20000)]
    + [(5, i, ["system", "user", "assistant"][0 if i == 0 else 1 + i % 2], f"turn {i} " + "word " * (i % 40)) for i in range(300)]
)


@pytest.mark.parametrize("budget,history", [(1024, 256), (60, 20), (1, 0), (10**9, 5)])
def test_windows(spark, budget, history):
    turns = spark.createDataFrame([(*r, "w", 1) for r in ROWS], SCHEMA)
    formatted = chat.format_chats(turns, PATH, PATTERN, budget, history)
    check(chat.read_back(formatted).collect(), ROWS)
    for w in formatted.collect():
        shown = chat.read(w.text)
        assert len(shown) > w.repeated
        assert w.tokens <= budget or len(shown) - w.repeated == 1
        if w.conv_id == 5:
            assert shown[0] == ("system", "turn 0 ")
        targets = [chat.unescape(w.text[s.start : s.end]) for s in w.loss]
        assert targets == [t for r, t in shown[w.repeated :] if r == "assistant"]


def long_rows(n):
    """A conversation of ``n`` turns, one of equal turns and without an id, and two short ones."""
    roles = ["user", "assistant"]
    rows = [(7, i, "system" if i == 0 else roles[i % 2], f"turn {i} " + "word " * (i * 7 % 23)) for i in range(n)]
    rows += [(None, 1, "assistant", "same </s> words")] * (n // 10)
    rows += [(8, 0, "system", "s"), (8, 1, "assistant", "t"), (9, None, None, None)]
    return rows


@pytest.mark.parametrize("budget,history,run_tokens", [(1024, 256, 50_000), (60, 20, 100), (200, 300, 1)])
def test_long_conversations_in_runs(spark, budget, history, run_tokens):
    rows = long_rows(100_000 if run_tokens == 50_000 else 600)
    kept = dict(budget=budget, history=history, long_bytes=500, run_tokens=run_tokens)
    turns = spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA)
    parts = chat.formatted_parts(turns, PATH, PATTERN, **kept)
    parts = [stage(part.withColumn("task", F.spark_partition_id()), "windows") for part in parts]
    check(chat.read_back(*chat.formatted_parts(turns, PATH, PATTERN, **kept)).collect(), rows)
    assert {w.conv_id for w in parts[0].collect()} == {8, 9}
    windows = sorted((w for w in parts[1].collect() if w.conv_id == 7), key=lambda w: (w.run, w.window))
    coder = chat.encoding(PATH, PATTERN)
    tokens = [len(coder.encode_ordinary(chat.render(r, t)[0])) for c, _, r, t in rows if c == 7]
    told = [(r, t) for c, _, r, t in rows if c == 7]
    shown, before = 0, 0
    for w in windows:
        turns_of = chat.read(w.text)
        fresh = len(turns_of) - w.repeated
        assert turns_of[w.repeated :] == told[shown : shown + fresh]
        assert w.run == before // max(run_tokens, history) or w.window > 0
        if shown:
            assert turns_of[0] == told[0] and turns_of[1 : w.repeated] == told[shown - w.repeated + 1 : shown]
            room = min(history, budget - tokens[0] - tokens[shown])
            most = next(k for k in range(shown) if sum(tokens[shown - k - 1 : shown]) > room or k + 1 == shown)
            assert w.repeated - 1 == most
        shown, before = shown + fresh, before + sum(tokens[shown : shown + fresh])
    assert shown == len(told)
    if run_tokens == 50_000:
        assert len({w.run for w in windows}) == -(-sum(tokens) // run_tokens) and len({w.task for w in windows}) > 1


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.format_chats(none, PATH, PATTERN).count() == 0 and chat.read_back(chat.format_chats(none, PATH, PATTERN)).count() == 0
