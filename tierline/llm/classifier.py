"""A quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A text is compressed with
each, block by block so that the dictionary rather than the text's own history decides; the difference
of the sizes, normalised by their sum, and the share of the text that remains are calibrated by
logistic regression to the probability of label 1.

The fit takes a bounded, documented sample of labelled rows; scoring takes every row and whole texts,
in bounded memory. Null text counts as empty and gets the score of no evidence, the share of label 1.
Equal texts get equal scores whatever their keys; an empty table gives an empty one. Labels that are
null or contradict each other for a key are not learned from; without two classes to learn from every
score is the share of label 1, or one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 2000  # labelled rows of each class
SAMPLE_BYTES = 1 << 16  # longer texts are not learned from
DICTIONARY_BYTES = 1 << 16
BLOCK = 2048
LEVEL = 3
SHORT = 100  # bytes at which half the evidence counts
THRESHOLD = 0.7


def remainder(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; rows with 2 are held out."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 4


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of 1, difference, share left
    prior: float
    usual: float = 0.0  # share of a good text that remains

    def features(self, texts: list[str]) -> np.ndarray:
        packers = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(d), write_content_size=False, write_dict_id=False)
            for d in (self.good, self.bad)
        ]
        rows = np.zeros((len(texts), 2))
        for row, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            if not data:
                continue
            good, bad = (sum(len(p.compress(data[at : at + BLOCK])) for at in range(0, len(data), BLOCK)) for p in packers)
            sure = len(data) / (len(data) + SHORT)  # little text is little evidence
            rows[row] = sure * (bad - good) / (bad + good), sure * (min(good, bad) / len(data) - self.usual)
        return rows

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        found = _logistic(self.features(texts), np.array(self.weights))
        return np.where([bool(t) for t in texts], found, self.prior)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)


def _logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -35, 35)))


def _build(texts: list[str]) -> bytes:
    """A trained dictionary, or the texts' own bytes where there are too few to train on."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    blocks = [d[at : at + BLOCK] for d in data for at in range(0, len(d), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps on standardised features, slightly ridged."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        curve = weight * p * (1 - p)
        step = np.linalg.solve((design * curve[:, None]).T @ design + 1e-2 * np.eye(len(w)), design.T @ (weight * (y - p)) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / spread
    return np.concatenate([[w[0] - slopes @ mean], slopes])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS
) -> Model:
    """Learns from at most ``rows`` texts of each class, chosen by a hash of their key.

    Every other one goes into the dictionaries, the rest calibrate. ``labels`` must already be without
    held-out keys. The sample's keys are broadcast and its texts come to the driver: at most
    2 * rows * SAMPLE_BYTES.
    """
    agreed = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("k"))
        .agg(F.min(label).alias("y"), F.max(label).alias("z"))
        .filter("y = z")
        .select("k", "y", F.xxhash64(F.lit(3), "k").alias("h"))
    )
    shares = dict(agreed.groupBy("y").count().collect())
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    if len(shares) < 2:
        return Model(b"", b"", (), prior)
    chosen = [agreed.filter(F.col("y") == y).orderBy("h", "k").limit(rows) for y in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.octet_length("t").between(1, SAMPLE_BYTES))
    found = own.join(F.broadcast(sample), "k").groupBy("k", "y", "h").agg(F.min("t").alias("t")).orderBy("h", "k").collect()
    by_class = [[r["t"] for r in found if r["y"] == y] for y in (0, 1)]
    if min(map(len, by_class)) < 2:
        return Model(b"", b"", (), prior)
    bad, good = (_build(texts[::2]) for texts in by_class)
    rest = [texts[1::2] for texts in by_class]
    plain = Model(good, bad, (), prior)
    usual = float(np.median(plain.features([t for t in rest[1] if len(t) > BLOCK] or rest[1])[:, 1]))
    plain = replace(plain, usual=usual)
    x = plain.features(rest[0] + rest[1])
    y = np.repeat([0.0, 1.0], [len(r) for r in rest])
    weight = np.where(y == 1, prior / len(rest[1]), (1 - prior) / len(rest[0])) * len(y)
    return replace(plain, weights=tuple(float(w) for w in _fit(x, y, weight)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each row."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = model.scores([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=schema.names)

    return docs.select(key, F.col(text).alias("text")).mapInArrow(scored, schema)
