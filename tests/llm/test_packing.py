"""Packing: ids against the library, places against what a packing must satisfy."""

import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierline.llm import packing
from tierline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = [
    None, "", " ", "\x1c", "a\x1cb\x85c d", "It's Bob's, they'll 'tis", "<|endoftext|> x<|startoftext|>y <|EndOfText|>",
    "İstanbul ΣΑΣ ﬁ ǅ ß", "é ́x ä_b", "𝔘𝕟𝕚 漢字 한글 한", "x__y__1234 5th $%^ -- ...don't", " nbsp　wide​zero",
    "naïve ÀÉÎ ª º µ x² ½ Ⅳ Œuvre ĲĳŁł ŉ \x00\x7f\xad¡a¡ ÿŸ", "tab\tnew\nline\r\n", "word " * 9000, "A1b2C3" * 3000,
]


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_equal_the_library():
    coder = packing.PieceTokenizer(PATH, "<u2")
    texts = [t or "" for t in EDGES]
    for text, found in zip(texts + texts, coder.encode(texts) + coder.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == library_ids(text)[:-1], text[:40]


def test_ids_of_real_texts(spark):
    coder = packing.PieceTokenizer(PATH, "<u2")
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for text, found in zip(texts, coder.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == library_ids(text)[:-1]


def test_every_sign_below_the_letters(spark):
    coder = packing.PieceTokenizer(PATH, "<u2")
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}1{chr(c)}" for c in range(0x400)]
    for text, found in zip(texts, coder.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == library_ids(text)[:-1], repr(text)


def test_colliding_pieces():
    """Words of letters in the order of parity of bits, and with the letters exchanged: a polynomial with
    an odd factor gives both one value modulo 2^64."""
    order = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = "".join("ab"[x] for x in order), "".join("ba"[x] for x in order)
    for texts in ([one, other], [one + " c", "c " + other, one + " " + other]):
        coder = packing.PieceTokenizer(PATH, "<u2")
        starts = coder._hashes(np.frombuffer((one + other).encode(), np.uint8), np.array([0, 2048]), np.array([2048, 4096]))
        assert starts[0] == starts[1]
        for _ in range(2):
            for text, found in zip(texts, coder.encode(texts)):
                assert np.frombuffer(found, "<u2").tolist() == library_ids(text)[:-1]
        for text in texts:
            assert np.frombuffer(coder.encode([text])[0], "<u2").tolist() == library_ids(text)[:-1]


def test_few_pieces_kept_and_short_segments(monkeypatch):
    monkeypatch.setattr(packing, "PIECES_KEPT", 20)
    monkeypatch.setattr(packing, "SEGMENT", 50)
    coder = packing.PieceTokenizer(PATH, "<u2")
    texts = [t or "" for t in EDGES if len(t or "") < 5000] + [" ".join(f"w{i % 37} plain Text{i}" for i in range(300))]
    for _ in range(2):
        for text, found in zip(texts, coder.encode(texts)):
            assert np.frombuffer(found, "<u2").tolist() == library_ids(text)[:-1], text[:40]


def brute_best_fit(lengths, capacity):
    bins, at = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [b for b in range(len(bins)) if bins[b] >= lengths[i]]
        if fits:
            into = min(fits, key=lambda b: bins[b])
        else:
            into = len(bins)
            bins.append(capacity)
        bins[into] -= lengths[i]
        at[i] = into
    return len(bins), sorted(bins)


@pytest.mark.parametrize("capacity,high", [(10, 10), (4096, 4096), (100, 30), (7, 3), (1, 1)])
def test_best_fit_equals_brute_force(capacity, high):
    lengths = np.random.default_rng(capacity).integers(1, high + 1, 400)
    sequence, _ = packing.best_fit(lengths, capacity)
    left = [capacity] * (sequence.max() + 1)
    for s, n in zip(sequence, lengths):
        left[s] -= n
    assert (len(left), sorted(left)) == brute_best_fit(lengths.tolist(), capacity)


def check(rows, docs, capacity=4096):
    want = []
    for d in docs:
        ids = np.asarray(library_ids(d.text), "<u4")
        want += [(d.doc_id or -1, i, zlib.crc32(ids[i : i + capacity].tobytes())) for i in range(0, len(ids), capacity)]
    assert sorted(want) == sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in rows)
    bins = defaultdict(list)
    for r in rows:
        assert r.start == r.piece * capacity
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = QUERIES["op1_best_fit_packing"](spark, folder).collect()
    assert check(rows, docs) <= math.ceil(sum(r.length for r in rows) / 4096) + 2


def test_edges(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(EDGES)] * 2 + [(None, "x", 1)], "doc_id long, text string, piece int")
    rows = packing.pack(docs, PATH).withColumn("ids_crc32", F.crc32("ids")).collect()
    check(rows, docs.collect())
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_chunks_bound_a_task(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 50)
    docs = spark.createDataFrame([(i, "a b c " * (i % 9)) for i in range(400)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, PATH, capacity=40).collect()
    places = defaultdict(int)
    for r in rows:
        places[r.sequence_id] += r.length
    assert len(rows) == 400
    assert max(places.values()) <= 40
