"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-cased runs of [0-9a-z] and non-ASCII characters. Features are the distinct hashes, in 2 ** bits slots, of
words, of neighbouring pairs and of pairs with one word between. Each slot has its own learning rate and an L1 penalty
that keeps most weights at exactly 0, so what is broadcast is the list of slots with a weight (at most 2 ** bits).

Training reads labelled rows only. It is bounded: of the eligible rows the `max_train` with the smallest seeded hash are
taken, a documented parameter (see fit). Scoring covers every whole text.

Defined results: null and empty texts have no features and score the bias alone; with no labelled rows, or one class
only, the model is the smoothed share of toxic labels; a document with several labels is trained on each once, null
labels on none; ties in the sampling hash fall by id; repeated rows score alike; other columns pass through.

Scale: features are made where the documents are; only the sampled rows' slot numbers move, to one training task of at
most max_train rows, each with all its distinct slots (at most 2 ** bits); sorted before, they come batch by batch.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from zonalith.llm import words as W
from zonalith.session import reach_workers

BITS = 20
MAX_TRAIN, EPOCHS = 12_000, 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.5
MOST_UP = 2.0


class Model(NamedTuple):
    bias: float
    slots: np.ndarray  # sorted
    weights: np.ndarray
    bits: int

    def table(self) -> np.ndarray:
        w = np.zeros(1 << self.bits)
        w[self.slots] = self.weights
        return w


def features(w: W.Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot), distinct and sorted, of a slice."""
    n, doc = len(w.hash), np.repeat(np.arange(len(w.of) - 1), np.diff(w.of))
    kinds = [(doc, w.hash)]
    for gap, salt in ((1, 0x51ED270B7A14C5F1), (2, 0x2545F4914F6CDD1D)):
        if n > gap:
            same = doc[:-gap] == doc[gap:]
            h = W.mix(w.hash[:-gap] * W.WORD_BASE + w.hash[gap:] + W.U64(salt))
            kinds.append((doc[:-gap][same], h[same]))
    shift = W.U64(64 - bits)
    key = np.concatenate([(d.astype(np.uint64) << W.U64(bits)) | (h >> shift) for d, h in kinds])
    key = np.unique(key)
    return (key >> W.U64(bits)).astype(np.int64), (key & W.U64((1 << bits) - 1)).astype(np.int64)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Per-coordinate FTRL-proximal; rows in the given order, `epochs` times."""
    n_pos, n = float(labels.sum()), len(labels)
    if not 0 < n_pos < n:
        p = (n_pos + 0.5) / (n + 1.0)
        return Model(math.log(p / (1 - p)) if n else 0.0, np.zeros(0, np.int64), np.zeros(0), bits)
    z, g2 = np.zeros(1 << bits), np.zeros(1 << bits)
    zb, gb = 0.0, 0.0
    # The rarer label weighs more, up to MOST_UP.
    up = min((n - n_pos) / n_pos, MOST_UP)
    for _ in range(epochs):
        for slots, y in zip(rows, labels.tolist(), strict=True):
            zs, gs = z[slots], g2[slots]
            w = np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(gs)) / ALPHA + L2))
            b = -zb / ((BETA + math.sqrt(gb)) / ALPHA)
            p = 1.0 / (1.0 + math.exp(-max(min(float(w.sum()) + b, 35.0), -35.0)))
            g = (p - y) * (up if y else 1.0)
            s = (np.sqrt(gs + g * g) - np.sqrt(gs)) / ALPHA
            z[slots] = zs + g - s * w
            g2[slots] = gs + g * g
            zb += g - (math.sqrt(gb + g * g) - math.sqrt(gb)) / ALPHA * b
            gb += g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g2)) / ALPHA + L2))
    slots = np.flatnonzero(w)
    return Model(-zb / ((BETA + math.sqrt(gb)) / ALPHA), slots, w[slots], bits)


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", eligible: Column | None = None, max_train: int = MAX_TRAIN, bits: int = BITS, seed: int = 41) -> Model:
    """Learn from at most max_train labelled rows for which `eligible` (a condition on labels) holds."""
    reach_workers(docs.sparkSession)
    own = labels.where(eligible) if eligible is not None else labels
    own = own.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
    own = own.distinct().withColumn("r", F.xxhash64(F.lit(seed), F.col("id").cast("string")))
    # The sample is bounded by max_train, and so is what is broadcast.
    sample = own.orderBy("r", "id", "y").limit(max_train)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = text.join(F.broadcast(sample), "id")

    def extract(batches):
        for batch in batches:
            ids = []
            for lo, hi, data, at in W.slices(batch.column("text")):
                doc, slot = features(W.find(data, at, W.ALNUM_MASK, lower=True), bits)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                ids += [slot[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("r"), pa.array(ids, pa.binary())], names=["y", "r", "slots"])

    made = rows.select("text", "y", "r").mapInArrow(extract, "y int, r long, slots binary")

    def train(batches):
        rows, y = [], []
        for batch in batches:
            rows += [np.frombuffer(x, np.int32) for x in batch.column("slots").to_pylist()]
            y += batch.column("y").to_pylist()
        m = ftrl(rows, np.array(y), bits)
        yield pa.RecordBatch.from_arrays([pa.array([m.bias]), pa.array([m.slots.astype(np.int32).tobytes()], pa.binary()), pa.array([m.weights.tobytes()], pa.binary())], names=["b", "s", "w"])

    got = made.repartition(1).sortWithinPartitions("r", "y", "slots").mapInArrow(train, "b double, s binary, w binary").collect()
    if not got:
        return ftrl([], np.zeros(0), bits)
    return Model(got[0]["b"], np.frombuffer(got[0]["s"], np.int32).astype(np.int64), np.frombuffer(got[0]["w"]), bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with the probability of toxicity last, as out_col or the next free name."""
    spark = docs.sparkSession
    reach_workers(spark)
    shared = spark.sparkContext.broadcast(model)
    inner = [f"c{k}" for k in range(len(docs.columns))]
    own = docs.toDF(*inner)
    text = inner[docs.columns.index(text_col)]

    def run(batches):
        m = shared.value
        table = m.table()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, data, at in W.slices(batch.column(batch.schema.names.index(text))):
                doc, slot = features(W.find(data, at, W.ALNUM_MASK, lower=True), m.bits)
                out[lo:hi] = np.bincount(doc, weights=table[slot], minlength=hi - lo)
            p = 1.0 / (1.0 + np.exp(-np.clip(out + m.bias, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*inner, "p"])

    schema = StructType(list(own.schema.fields)).add("p", "double")
    out = own.mapInArrow(run, schema)
    return out.select(*[F.col(c).alias(n) for c, n in zip(inner, docs.columns, strict=True)], F.col("p").alias(W.free(out_col, docs.columns)))
