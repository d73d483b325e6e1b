"""Quality rules against a plain Python version."""

import re
from collections import Counter

import compare
import pytest

from tierline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated), failed,
    )


PROSE = " ".join(f"the word{i} of" for i in range(40))
TEXTS = [
    None, "", " \n\t ", "one", "a b c", "a b c a b c", "a a a a a", "x\x0by\x0cz\r\nx", "naïve 漢字 𝔘    x",
    PROSE, PROSE + " ###" * 60, "the same line of it\n" * 80, "ab " * 30000, " ".join(f"w{i % 700}" for i in range(9000)),
    PROSE + "\n\n" + PROSE, "### $$ %% | <b> & *",
]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", True) for i, t in enumerate(TEXTS)], "doc_id long, text string, kept string, m boolean")
    rows = {r.doc_id: r for r in quality.judged(docs).collect()}
    for i, text in enumerate(TEXTS):
        r = rows[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(text), text and text[:40]
        assert not (r.base_failed and r.kept)


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in quality.judged(docs).collect()}
    for doc in docs.collect():
        r = rows[doc.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(doc.text)


def test_verdicts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    kept = {r.doc_id for r in quality.judged(docs).filter("kept").collect()}
    assert kept == {9}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept


def test_plan_has_no_shuffle_and_no_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    plan = quality.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judged(empty).count() == 0 and quality.keep_good(empty).count() == 0
    twice = spark.createDataFrame([(None, PROSE), (None, PROSE)], "doc_id long, text string")
    assert [r.kept for r in quality.judged(twice).collect()] == [True, True]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert compare.differences(quality.judged(docs), compare.duck(f"/root/testdata/{sf}"), quality.oracle()) == []
