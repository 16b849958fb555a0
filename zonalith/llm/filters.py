"""A bit filter of the 64-bit tokens that occur in several places of a corpus.

Tokens move packed, by bucket (their top bits); each bucket fills its own stretch of the bits, so the filter is put
together without a merge. Buckets and bits follow the size of the corpus, the bits up to MOST_BITS (a broadcast of
128 MB at most); a filter that fills up lets more tokens through and never holds one back.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

U64 = np.uint64
FLUSH, BUCKET_BYTES, MOST_BITS = 1 << 21, 4 << 20, 30
PACKED = "bucket int, tokens binary, nodes binary"


class Shape(NamedTuple):
    bucket_bits: int
    filter_bits: int


def shape_for(corpus_bytes: int) -> Shape:
    """A bucket for each 4 MB of text, a bit for each 6 bytes."""
    bits = max(20, min(MOST_BITS, math.ceil(math.log2(max(corpus_bytes / 6, 1)))))
    return Shape(max(4, min(bits - 4, math.ceil(math.log2(max(corpus_bytes / BUCKET_BYTES, 1))))), bits)


class Packer:
    """Collects (token, node) and gives them out as packed rows. Without nodes, every occurrence is a place of its own and
    a token keeps 32 bits below its bucket's: two tokens taken for one only let more through."""

    def __init__(self, shape: Shape):
        self.shape, self.tokens, self.nodes, self.held = shape, [], [], 0

    def add(self, tokens: np.ndarray, nodes: np.ndarray | None = None) -> bool:
        """True when it is time to flush."""
        self.tokens.append(tokens)
        if nodes is not None:
            self.nodes.append(nodes)
        self.held += len(tokens)
        return self.held >= FLUSH

    def flush(self):
        t, bits = np.concatenate(self.tokens), self.shape.bucket_bits
        if self.nodes:
            order = np.argsort(t)
            t, o = t[order], np.concatenate(self.nodes)[order]
        else:
            t, o = np.sort(t), None
            third = np.zeros(len(t), bool)  # two occurrences tell as much as many
            third[2:] = t[2:] == t[:-2]
            t = t[~third]
        self.tokens, self.nodes, self.held = [], [], 0
        cut = np.searchsorted(t, np.arange(1 << bits).astype(U64) << U64(64 - bits))
        cut = np.append(cut, len(t))
        full = np.flatnonzero(np.diff(cut))
        if o is None:
            t = (t >> U64(32 - bits)).astype(np.uint32)
        for lo in range(0, len(full), 256):
            part = full[lo : lo + 256]
            nodes = [b"" if o is None else o[cut[b] : cut[b + 1]].tobytes() for b in part]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array([t[cut[b] : cut[b + 1]].tobytes() for b in part], pa.binary()), pa.array(nodes, pa.binary())], names=["bucket", "tokens", "nodes"])


class _Bucket:
    """The tokens so far with a node of each, and whether there was another; merged when as much is pending as is known."""

    def __init__(self):
        self.t, self.o, self.multi, self.pending, self.size = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, bool), [], 0

    def add(self, t: np.ndarray, o: np.ndarray | None) -> None:
        self.pending.append((t, o))
        self.size += len(t)
        if self.size > max(1 << 18, len(self.t)):
            self.merge()

    def merge(self) -> None:
        if not self.size:
            return
        places = self.pending[0][1] is None
        t = np.concatenate([self.t, *[p[0] for p in self.pending]])
        multi = np.concatenate([self.multi, np.zeros(self.size, bool)])
        order = np.argsort(t, kind="stable")
        t, multi = t[order], multi[order]
        new = np.ones(len(t), bool)
        new[1:] = t[1:] != t[:-1]
        at = np.flatnonzero(new)
        if places:
            other = ~new
        else:
            o = np.concatenate([self.o, *[p[1] for p in self.pending]])[order]
            other = o != o[at][np.cumsum(new) - 1]
            self.o = o[at]
        self.t, self.multi, self.pending, self.size = t[at], np.logical_or.reduceat(multi | other, at), [], 0


def shared_bits(packed: DataFrame, shape: Shape) -> np.ndarray:
    """The filter of the tokens of packed rows that occur with two nodes or in two places."""
    bits, width = shape.bucket_bits, shape.filter_bits - shape.bucket_bits

    def find(batches):
        known: dict[int, _Bucket] = {}
        for batch in batches:
            for b, t, o in zip(*(batch.column(c).to_pylist() for c in ("bucket", "tokens", "nodes")), strict=True):
                if o:
                    known.setdefault(b, _Bucket()).add(np.frombuffer(t, U64), np.frombuffer(o, np.int64))
                else:
                    known.setdefault(b, _Bucket()).add((np.frombuffer(t, np.uint32).astype(U64) << U64(32 - bits)) | (U64(b) << U64(64 - bits)), None)
        for b, have in known.items():
            have.merge()
            mine = np.zeros(1 << width, bool)
            mine[((have.t[have.multi] >> U64(64 - shape.filter_bits)) & U64((1 << width) - 1)).astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(mine).tobytes()], pa.binary())], names=["bucket", "bits"])


    made = packed.repartitionById(1 << bits, F.col("bucket")).mapInArrow(find, "bucket int, bits binary")
    out = np.zeros(1 << (shape.filter_bits - 3), np.uint8)
    size = len(out) >> bits
    for b, got in made.collect():
        out[b * size : (b + 1) * size] = np.frombuffer(got, np.uint8)
    return out


def inside(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = (tokens >> U64(64 - int(np.log2(len(bits))) - 3)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
