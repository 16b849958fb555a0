"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training windows.

Words are lower-cased runs of [0-9a-z] and non-ASCII characters. A window is `n` consecutive words of an item; an item of
fewer words, but not none, is one window. A document word inside any occurrence of a window is hit. Every hash hit is
verified against the words themselves.

Defined results: null and empty texts have no words; repeated rows are judged alike; items with a null id still hit but
are not listed; an empty benchmark hits nothing; very long texts are scanned whole; equal windows of several items count for
each; other columns, whatever their names, pass through untouched.

Scale: documents are scanned where they are, without a shuffle. The benchmark is broadcast in slices of at most
`slice_bytes` of text; its size is summed first, and a larger benchmark is taken slice by slice, each a pass over the
documents whose mask of hit words is carried in a staged table. Memory is that of one slice and one batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from zonalith.llm import words as W
from zonalith.session import reach_workers, staged

SLICE_BYTES = 8 << 20
BLOOM_BITS = 20
REPORT = {"n_words": LongType(), "n_hit": LongType(), "items": ArrayType(StringType()), "hit_mask": BinaryType()}


class Windows:
    """The windows of one slice of the benchmark, by their length in words."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.ids = [None if i is None else str(i) for i, _ in items]
        col = pa.array([t or "" for _, t in items], pa.large_string())
        data, at = W.buffers(col)
        w = W.find(data[: at[-1]], at, W.ALNUM_MASK, lower=True)
        joined, starts, pos = [], np.zeros(len(w.starts) + 1, np.int64), 0
        for k, (a, b) in enumerate(zip(w.starts.tolist(), w.ends.tolist(), strict=True)):
            joined.append(w.data[a:b].tobytes())
            starts[k] = pos
            pos += b - a + 1
        starts[-1] = pos
        self.text, self.starts = b" ".join(joined), starts
        counts = np.diff(w.of)
        self.by_length = {}
        for length in sorted({n, *counts[(counts > 0) & (counts < n)].tolist()}):
            ok = W.whole(w.of, length, len(w.hash) - length + 1)
            at = np.flatnonzero(ok)
            item = np.searchsorted(w.of, at, side="right") - 1
            if length < n:
                keep = counts[item] == length
                at, item = at[keep], item[keep]
            if not len(at):
                continue
            h = W.grams(w.hash, length)[at]
            order = np.argsort(h, kind="stable")
            h, at, item = h[order], at[order], item[order]
            bloom = np.zeros(1 << BLOOM_BITS, dtype=bool)
            bloom[(h >> W.U64(64 - BLOOM_BITS)).astype(np.int64)] = True
            self.by_length[length] = (h, at, item, bloom)

    def scan(self, w: W.Words, hit: np.ndarray, found: list[set[int]]) -> None:
        """Mark the hit words of a slice of documents and note the items found in each."""
        for length, (h, at, item, bloom) in self.by_length.items():
            g = W.grams(w.hash, length)
            if not len(g):
                continue
            maybe = np.flatnonzero(bloom[(g >> W.U64(64 - BLOOM_BITS)).astype(np.int64)] & W.whole(w.of, length, len(g)))
            lo = np.searchsorted(h, g[maybe], side="left")
            hi = np.searchsorted(h, g[maybe], side="right")
            keep = hi > lo
            maybe, lo, hi = maybe[keep], lo[keep], hi[keep]
            doc = np.searchsorted(w.of, maybe, side="right") - 1
            flags = np.zeros(len(g), dtype=bool)
            for i, a, b, d in zip(maybe.tolist(), lo.tolist(), hi.tolist(), doc.tolist(), strict=True):
                words = b" ".join(w.data[s:e].tobytes() for s, e in zip(w.starts[i : i + length], w.ends[i : i + length], strict=True))
                for k in range(a, b):
                    s = at[k]
                    if self.text[self.starts[s] : self.starts[s + length] - 1] == words:
                        flags[i] = True
                        found[d].add(int(item[k]))
            hit |= W.cover(flags, length, len(w.hash))


def slices_of(benchmark: DataFrame, item_col: str, text_col: str, slice_bytes: int):
    """The benchmark in slices of about slice_bytes, each fetched when it is its turn."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    total = items.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)))).first()[0] or 0
    k = max(1, math.ceil(total / slice_bytes))
    for j in range(k):
        part = items if k == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(k)) == j)
        yield j, k, part.collect()


def _scanner(shared, text_col: str, out_names: list[str], carried: bool):
    def run(batches):
        windows = shared.value
        for batch in batches:
            names = batch.schema.names
            own = len(names) - (4 if carried else 0)
            text = batch.column(names.index(text_col))
            n_words, n_hit, items, masks = [], [], [], []
            old = batch.column(own + 3).to_pylist() if carried else None
            seen = batch.column(own + 2).to_pylist() if carried else None
            for lo, hi, data, docs in W.slices(text):
                w = W.find(data, docs, W.ALNUM_MASK, lower=True)
                hit = np.zeros(len(w.starts), dtype=bool)
                found = [set() for _ in range(hi - lo)]
                windows.scan(w, hit, found)
                for d in range(hi - lo):
                    mask = hit[w.of[d] : w.of[d + 1]]
                    ids = {windows.ids[k] for k in found[d]}
                    if carried:
                        mask = mask | np.unpackbits(np.frombuffer(old[lo + d], np.uint8), count=len(mask)).astype(bool)
                        ids |= set(seen[lo + d])
                    n_words.append(len(mask))
                    n_hit.append(int(mask.sum()))
                    items.append(sorted(x for x in ids if x is not None))
                    masks.append(np.packbits(mask).tobytes())
            columns = [batch.column(k) for k in range(own)]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(masks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=out_names)

    return run


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """docs with a struct column last, `scan` or the next free name: n_words, n_hit, items (ids found, sorted), hit_mask (a bit for
    each word)."""
    spark = docs.sparkSession
    reach_workers(spark)
    inner = [f"c{k}" for k in range(len(docs.columns))]
    text = inner[docs.columns.index(text_col)]
    out = docs.toDF(*inner)
    schema = StructType(list(out.schema.fields))
    for name, kind in REPORT.items():
        schema = schema.add(name, kind)
    for j, k, items in slices_of(benchmark, item_col, item_text, slice_bytes):
        shared = spark.sparkContext.broadcast(Windows([(r[0], r[1]) for r in items], n))
        out = out.mapInArrow(_scanner(shared, text, schema.names, carried=j > 0), schema)
        if k > 1:
            out = staged(out, f"scan-{j}")
            shared.unpersist()
    report = F.struct(*REPORT).alias(W.free("scan", docs.columns))
    return out.select(*[F.col(c).alias(name) for c, name in zip(inner, docs.columns, strict=True)], report)


def strip_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """Span removal: hit words go, and the kept words and everything between kept words stay as they were."""
    inner = [f"c{k}" for k in range(len(scanned.columns) - 1)]
    names = scanned.columns[:-1]
    text = inner[names.index(text_col)]
    flat = scanned.select(*[F.col(f"`{n}`").alias(c) for c, n in zip(inner, names, strict=True)], F.col(f"`{scanned.columns[-1]}`.hit_mask").alias("m"))

    def run(batches):
        for batch in batches:
            at, out = batch.schema.names.index(text), []
            masks = batch.column(len(inner)).to_pylist()
            column = batch.column(at)
            for lo, hi, data, docs in W.slices(column):
                w = W.find(data, docs, W.ALNUM_MASK, lower=True, hashed=False)
                for d in range(lo, hi):
                    a, b = w.of[d - lo], w.of[d - lo + 1]
                    hit = np.unpackbits(np.frombuffer(masks[d], np.uint8), count=b - a).astype(bool)
                    raw = data[docs[d - lo] : docs[d - lo + 1]]
                    if hit.any():
                        gone = np.zeros(len(raw) + 1, np.int32)
                        np.add.at(gone, w.starts[a:b][hit] - docs[d - lo], 1)
                        np.add.at(gone, w.ends[a:b][hit] - docs[d - lo], -1)
                        raw = raw[np.cumsum(gone[:-1]) == 0]
                    out.append(raw.tobytes().decode("utf-8"))
            new = pc.if_else(pc.is_null(column), pa.scalar(None, pa.string()), pa.array(out, pa.string()))
            yield pa.RecordBatch.from_arrays([new if k == at else batch.column(k) for k in range(len(inner))], names=inner)

    schema = StructType([flat.schema[c] for c in inner])
    return flat.mapInArrow(run, schema).toDF(*names)


def drop_documents(scanned: DataFrame) -> DataFrame:
    """Document removal: documents with a hit word go."""
    report = scanned.columns[-1]
    return scanned.where(F.col(f"`{report}`.n_hit") == 0).drop(report)
