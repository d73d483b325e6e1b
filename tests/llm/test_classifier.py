"""The compression classifier by held-out accuracy and its promises."""

import zlib

import numpy as np

from tierline.llm import classifier
from tierline.llm.queries import QUERIES


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op9_quality_classifier"](spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 10000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    known = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = (np.array([s for s, y in known if y == q]) for q in (1, 0))
    assert np.mean(good[:, None] > bad[None, :]) > 0.97
    assert np.mean(good >= 0.7) > 0.97 and np.mean(bad < 0.7) > 0.85


def test_held_out_labels_do_not_matter(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    taught = labels.filter(classifier.remainder(labels.doc_id) != 2)
    model = classifier.train(docs, taught)
    assert model == classifier.train(docs.repartition(3), taught.repartition(2))


def test_edges(spark):
    docs = spark.createDataFrame([(i, f"fine words number {i} of prose", "x") for i in range(40)] + [(50, None, "x"), (51, "", "x"), (None, "a", "x")] * 2,
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = [(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (None, 1)]
    for labels in (none, spark.createDataFrame(some, none.schema), spark.createDataFrame([(1, 1), (2, 0)], none.schema)):
        model = classifier.train(docs, labels)
        rows = classifier.score(docs, model).collect()
        assert len(rows) == 46 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (50, 51)}) == 1
    assert classifier.score(docs.limit(0), model).count() == 0
    assert classifier.train(docs.limit(0), spark.createDataFrame(some, none.schema)).weights == ()


def test_long_text_is_scored_whole():
    model = classifier.Model(b"good words " * 30, b"### bad ### " * 30, (0.0, 50.0, 0.0), 0.5)
    tail = model.scores(["good words " * 20000 + "### bad ### " * 200000])[0]
    assert tail < 0.5 < model.scores(["good words " * 20000])[0]
