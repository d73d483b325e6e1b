"""Collocations against SQL and plain counting."""

import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import phrases
from tierline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = QUERIES["op13_collocations"](spark, folder)
    assert compare.differences(found, compare.duck(folder), ORACLES["op13_collocations"]) == []


def brute(rows, least, longest, percent, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und" if lang is None else lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least}
        ranked = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def texts(seed=3, n=150):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "É", "é", "d-d", "\U0001d518x", "the", "\x00", "\x1c"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(60)):
            parts.append(rng.choice([rng.choice(vocabulary), "new York city", "The end", "x" * 30]))
            parts.append(rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "!?"]))
        out.append(("".join(parts), rng.choice(["en", "en", None, "und", "de", ""])))
    return out + [(None, "en"), ("", "fr"), (" \t.,", None), ("one", "fr"), ("long run " * 3000, "fr"), ("same same " * 40, "en")] + [("copied text of five words here", "de")] * 30


@pytest.mark.parametrize("least, chunk, shard, merged, percent", [(4, 65_000, 500_000, 1_000_000, 100), (2, 37, 9, 20, 80), (30, 5, 3, 1, 100)])
def test_against_plain_counts(spark, monkeypatch, least, chunk, shard, merged, percent):
    for name, value in (("CHUNK", chunk), ("SHARD", shard), ("MERGED", merged), ("SEGMENT", 50)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(n=150 if least > 2 else 12)
    if least == 2:
        rows = [(t[:400] if t else t, lang) for t, lang in rows]
    docs = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    found = phrases.collocations(docs, least=least, percent=percent, top=50)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, least, 5, percent, 50)


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, 1)], SCHEMA)).count() == 0


def test_other_seed_where_codes_meet(spark, monkeypatch):
    rows = [("left right " * 5, "en")]
    docs = spark.createDataFrame([(1, rows[0][0], "en", "x", 1)], SCHEMA)
    plain, seeds = phrases.coded, []

    def meeting(docs, text, lang, longest, seed):
        seeds.append(seed)
        found = plain(docs, text, lang, longest, seed)
        if seed == 42:  # both words under one code
            return found.withColumn("codes", phrases.F.transform("codes", lambda c: phrases.F.lit(7).cast("long")))
        return found

    monkeypatch.setattr(phrases, "coded", meeting)
    found = phrases.collocations(docs, least=2)
    assert seeds == [42, 43] and sorted(tuple(r) for r in found.collect()) == brute(rows, 2, 5, 100, 2000)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.lists(st.integers(-4, 12), min_size=3, max_size=3)), min_size=1, max_size=60), st.data())
def test_trie_finds_its_phrases(entries, data):
    entries = sorted({(lang, tuple(path)) for lang, path in entries})
    langs = ["a", "b", "c"]
    trie = phrases.Trie(langs, np.array([e[0] for e in entries]), np.array([e[1] for e in entries]))
    run = data.draw(st.lists(st.integers(-5, 13), max_size=40)) + [x for e in entries[:5] for x in e[1]]
    lang = data.draw(st.sampled_from([*langs, "unknown"]))
    own = data.draw(st.integers(0, len(run)))
    position, found = trie.accepted(lang, trie.steps(np.array(run, np.int64)), own, 3)
    want = [(i, entries.index((langs.index(lang), tuple(run[i : i + 3])))) for i in range(min(own, len(run) - 2))
            if lang in langs and (langs.index(lang), tuple(run[i : i + 3])) in entries]
    assert list(zip(position, found)) == want
