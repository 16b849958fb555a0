"""Substring dedup: windows of words that stand earlier in the corpus, found with compressed FM-indexes.

Words are runs of anything but ASCII white space, unchanged. A window is `n` consecutive words of one document. A word
goes when it is in a window whose words also start earlier: in a document of a smaller id, or earlier in the same one.

Routing. A window's minimizer is the least hash of the k-grams in it; equal windows have equal minimizers. Consecutive
windows of one minimizer make a segment, and a segment belongs to the shard of its minimizer, so all places of a window
meet in one shard and no document is held against every shard. Segments whose minimizer stands once in the corpus have
no equal window anywhere and go no further (a bit filter tells; what it lets through in vain costs time
only). Before they move, equal segments of a task are merged: the earliest is sent, the others are repeats already.

Shard. The words of its distinct segments are one sequence; its FM-index holds the Burrows-Wheeler transform in a wavelet
matrix of packed bits. Segments stream through it side by side, last word first: backward search gives the interval of
the last window; the interval of each window before it follows by dropping the last word (to the enclosing interval of
depth n - 1) and one more backward step. These are the matching statistics, cut at n. Intervals of two places and more are
reported; the earliest place in an interval decides. The suffix array goes when the index is built: enclosing intervals come
from a bit for each suffix, the earliest place is kept once for each repeated window.

Defined results: null text has no words; a null id comes after all others; rows of one id are one document's rows, none
of which is earlier than another at equal starts, so repeated rows stay; empty tables give empty results; other columns
are not carried; very long texts are cut into segments like others.

Scale: each pass reads texts where they are; they are shuffled once, to meet their removed ranges. Shards follow the
bytes of the corpus, so each stays near `shard_bytes` of text; a group of copies weighs as one copy for each task. At most
MOST_TASKS tasks take the shards in order, one at a time.
Words travel as 40 bits of their hash; a window is taken for equal when all n words are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from zonalith.llm import filters, words as W
from zonalith.session import reach_workers, small_batches, staged

N, K = 20, 6
MOST_WINDOWS, SHARD_BYTES, FLUSH_SEGMENTS, MOST_TASKS = 64, 2 << 20, 60_000, 1 << 13
LAST_ID = (1 << 63) - 1
U64 = np.uint64
INVERSE = U64(pow(int(W.WORD_BASE), -1, 1 << 64))


def segments_of(w: W.Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimizer) of each segment of a slice."""
    total = len(w.hash) - n + 1
    ok = W.whole(w.of, n, total)
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    g = W.grams(w.hash, k)
    wide, span = n - k + 1, 1
    low = g
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < wide:
        low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
    doc = np.searchsorted(w.of, np.arange(total), side="right")
    new = np.ones(total, bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])
    run = np.flatnonzero(new)
    since = np.arange(total) - run[np.cumsum(new) - 1]
    new |= since % MOST_WINDOWS == 0
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, total))
    keep = ok[at]
    return at[keep], size[keep], low[at[keep]]


def digests(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run h[start:end]."""
    out = []
    back = W.powers(INVERSE, len(h) + 1)[start]
    for salt in (0, 0x9E6C63D0876A9A47):
        terms = (W.mix(h ^ U64(salt)) if salt else h) * W.powers(W.WORD_BASE, len(h))
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(terms, dtype=U64)])
        out.append(W.mix((sums[end] - sums[start]) * back + (end - start).astype(U64)))
    return out[0], out[1]


def minimizer_filter(docs: DataFrame, shape: filters.Shape, n: int, k: int) -> np.ndarray:
    def emit(batches):
        packer = filters.Packer(shape)
        for batch in batches:
            for _, _, data, at in W.slices(batch.column("text")):
                w = W.find(data, at, W.SPACED_MASK)
                at, size, low = segments_of(w, n, k)
                # A minimizer that stands twice in one segment counts twice.
                g, span = W.grams(w.hash, k), size + n - k
                begin = np.cumsum(span) - span
                places = np.repeat(at, span) + np.arange(int(span.sum())) - np.repeat(begin, span)
                twice = np.add.reduceat((g[places] == np.repeat(low, span)).astype(np.int32), begin) > 1 if len(at) else np.zeros(0, bool)
                if len(low) and packer.add(np.concatenate([low, low[twice]])):
                    yield from packer.flush()
        if packer.held:
            yield from packer.flush()

    return filters.shared_bits(docs.mapInArrow(emit, filters.PACKED), shape)


RANGES = "id long, h long, start int, windows int"
ROUTED = f"{RANGES}, shard int, ids binary, hs binary, starts binary, counts binary, words binary"
FIELDS = [f.split(" ")[0] for f in ROUTED.split(", ")]


def route(docs: DataFrame, bits, shards: int, n: int, k: int) -> DataFrame:
    """Rows of two kinds: packed segments for a shard, and (words null, any shard) ranges of windows that repeat an equal segment of the task."""
    shift = U64(64 - int(math.log2(shards)))

    def emit(batches):
        held: list[tuple] = []
        count = 0

        def flush():
            low, ids, hs, start, size, d1, d2 = (np.concatenate([x[j] for x in held]) for j in range(7))
            body = np.concatenate([x[7] for x in held])
            first = np.cumsum(size + n - 1) - (size + n - 1)
            order = np.lexsort((hs, start, ids, d2, d1))
            new = np.ones(len(order), bool)
            a, b = order[1:], order[:-1]
            new[1:] = (d1[a] != d1[b]) | (d2[a] != d2[b])
            lead = order[new][np.cumsum(new) - 1]
            again = (ids[order] != ids[lead]) | (start[order] != start[lead])
            late = order[again]
            if len(late):
                # Known already, they only pass a shard; any will do, and copies must not all take the same.
                any_ = (W.mix(ids[late].astype(U64) * W.WORD_BASE + start[late].astype(U64)) & U64(shards - 1)).astype(np.int32)
                yield batch_of(ranges=(ids[late], hs[late], start[late], size[late], any_))
            keep = order[~again]
            shard = (low[keep] >> shift).astype(np.int64) if shards > 1 else np.zeros(len(keep), np.int64)
            by = np.argsort(shard, kind="stable")
            keep, shard = keep[by], shard[by]
            cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            rows = []
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(keep)], strict=True):
                s = keep[lo:hi]
                length = size[s] + n - 1
                at = np.repeat(first[s], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                rows.append((int(shard[lo]), ids[s].tobytes(), hs[s].tobytes(), start[s].astype("<i4").tobytes(), size[s].astype("<i4").tobytes(), body[at].tobytes()))
            for lo in range(0, len(rows), 32):
                yield batch_of(rows=rows[lo : lo + 32])

        for batch in batches:
            names, hash_ = batch.column("id").to_numpy(), batch.column("h").to_numpy()
            for lo, _, data, docs_at in W.slices(batch.column("text")):
                w = W.find(data, docs_at, W.SPACED_MASK)
                at, size, low = segments_of(w, n, k)
                keep = filters.inside(bits.value, low)
                at, size, low = at[keep], size[keep], low[keep]
                if not len(at):
                    continue
                end = at + size + n - 1
                d1, d2 = digests(w.hash, at, end)
                doc = np.searchsorted(w.of, at, side="right") - 1
                length = end - at
                place = np.repeat(at, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                five = np.ascontiguousarray(w.hash.view(np.uint8).reshape(-1, 8)[:, 3:])[place]
                held.append((low, names[lo + doc], hash_[lo + doc], at - w.of[doc], size, d1, d2, five))
                count += len(at)
                if count >= FLUSH_SEGMENTS:
                    yield from flush()
                    held, count = [], 0
        if count:
            yield from flush()

    return docs.mapInArrow(emit, ROUTED)


def batch_of(ranges: tuple | None = None, rows: list | None = None) -> pa.RecordBatch:
    k = len(ranges[0]) if ranges else len(rows)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
    if ranges:
        own = [pa.array(x.astype(np.int32) if t == pa.int32() else x, t) for x, t in zip(ranges, kinds, strict=False)]
        return pa.RecordBatch.from_arrays([*own, *[pa.nulls(k, t) for t in kinds[5:]]], names=FIELDS)
    own = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds[4:], strict=True)]
    return pa.RecordBatch.from_arrays([*[pa.nulls(k, t) for t in kinds[:4]], *own], names=FIELDS)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one packed bit row for each bit of a symbol."""

    def __init__(self, x: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.rows, self.sums, self.zeros = [], [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (x >> b) & 1 == 1
            padded = np.zeros((len(x) // 64 + 1) * 64, bool)
            padded[: len(x)] = bit
            words = np.packbits(padded, bitorder="little").view(U64)
            self.rows.append(words)
            self.sums.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]]).astype(np.int32))
            self.zeros.append(int(len(x) - bit.sum()))
            x = np.concatenate([x[~bit], x[bit]])
        every = np.arange(sigma)
        self.base = np.zeros(sigma, np.int64)
        self.base = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            at = i >> 6
            ones = self.sums[level][at] + np.bitwise_count(self.rows[level][at] & ((U64(1) << (i & 63).astype(U64)) - U64(1)))
            i = np.where((c >> b) & 1 == 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before place i."""
        return self._down(c, i) - self.base[c]


class Marks:
    """A row of packed bits, the first of them set, in which the nearest set bits about a place are found."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, bool)
        padded[: self.n], padded[self.n] = bits, True
        self.words = np.packbits(padded, bitorder="little").view(U64)
        at = np.flatnonzero(self.words).astype(np.int32)
        every = np.arange(len(self.words))
        self.before = at[np.searchsorted(at, every, "right") - 1]
        self.after = at[np.minimum(np.searchsorted(at, every), len(at) - 1)]

    def around(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last set bit at or before each place, and the next one behind it (or the end)."""
        full = U64(0xFFFFFFFFFFFFFFFF)
        w = i >> 6
        m = self.words[w] & (full >> (63 - (i & 63)).astype(U64))
        w = np.where(m == 0, self.before[np.maximum(w - 1, 0)], w)
        m = np.where(m == 0, self.words[w], m)
        top = (m >> U64(32)).astype(np.float64)
        high = np.where(top > 0, np.frexp(top)[1] + 31, np.frexp((m & U64(0xFFFFFFFF)).astype(np.float64))[1] - 1)
        lo = w * 64 + high
        w = (i + 1) >> 6
        m = self.words[w] & (full << ((i + 1) & 63).astype(U64))
        w = np.where(m == 0, self.after[np.minimum(w + 1, len(self.words) - 1)], w)
        m = np.where(m == 0, self.words[w], m)
        return lo, w * 64 + np.frexp((m & (~m + U64(1))).astype(np.float64))[1] - 1


class FMIndex:
    """Over a sequence of symbols below sigma. Suffixes are sorted by their first 32 symbols, which settles the interval of
    every pattern up to that length. Compressed: the suffix array is dropped once built; what stays is the wavelet matrix, a bit
    for each suffix that differs from the one before within `depth` symbols, and the least key of each repeated pattern of depth + 1."""

    def __init__(self, seq: np.ndarray, sigma: int, depth: int, key: np.ndarray):
        n = len(seq)
        rank, top, h = seq.astype(np.int64), sigma, 1
        while h < 32:
            after = np.zeros(n, np.int64)
            after[: n - h] = rank[h:] + 1
            order = rank * (top + 1) + after
            order, ties = np.argsort(order, kind="stable"), order
            new = np.ones(n, np.int64)
            new[0] = 0
            new[1:] = ties[order[1:]] != ties[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            top = int(rank[order[-1]]) + 1
            h *= 2
            if top == n:
                break
        sa = np.argsort(rank, kind="stable")
        self.n = n
        self.wavelet = WaveletMatrix(seq[sa - 1], sigma)
        counts = np.bincount(seq, minlength=sigma)
        self.first = np.cumsum(counts) - counts
        # Suffixes with equal first symbols stand together.
        padded = np.concatenate([W.mix(seq.astype(U64) + U64(1)), np.zeros(depth + 1, U64)])
        edge = lambda d: np.concatenate([[True], (g := W.grams(padded, d)[:n][sa])[1:] != g[:-1]])
        self.marks = Marks(edge(depth))
        begin = np.flatnonzero(edge(depth + 1))
        several = np.diff(np.append(begin, n)) > 1
        self.starts = begin[several].astype(np.int32)
        self.least = np.minimum.reduceat(key[sa], begin)[several]

    def widen(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals at `depth` symbols about those that begin at lo."""
        return self.marks.around(lo)

    def earliest(self, lo: np.ndarray) -> np.ndarray:
        """The least key of the repeated patterns of depth + 1 symbols whose intervals begin at lo."""
        return self.least[np.searchsorted(self.starts, lo)]

    def back(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with symbols c set before."""
        m = len(c)
        got = self.wavelet.rank(np.concatenate([c, c]), np.concatenate([lo, hi]))
        return self.first[c] + got[:m], self.first[c] + got[m:]


def repeats(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct segments (id, first window, windows, words one after another): (segment, window) of those that stand earlier too."""
    length = sizes + n - 1
    first = np.cumsum(length) - length
    _, dense = np.unique(words, return_inverse=True)
    sigma = int(dense.max()) + 2
    # Segments with a 0 behind each.
    at = first + np.arange(len(length))
    seq = np.zeros(int(length.sum()) + len(length), np.int64)
    spot = np.repeat(at, length) + np.arange(int(length.sum())) - np.repeat(first, length)
    seq[spot] = dense + 1
    _, doc = np.unique(ids, return_inverse=True)
    key = np.full(len(seq), np.iinfo(np.int64).max, np.int64)
    key[spot] = (np.repeat(doc.astype(np.int64), length) << 32) + np.repeat(starts, length) + spot - np.repeat(at, length)
    fm = FMIndex(seq, sigma, n - 1, key)
    order = np.argsort(-sizes, kind="stable")
    live = np.searchsorted(-sizes[order], -np.arange(int(sizes.max())), side="left")
    lo, hi = np.zeros(len(order), np.int64), np.full(len(order), fm.n, np.int64)
    last = at[order] + sizes[order] - 1
    for t in range(n - 1, -1, -1):
        lo, hi = fm.back(seq[last + t], lo, hi)
    found_s, found_w = [], []
    for t, k in enumerate(live.tolist()):
        lo, hi = lo[:k], hi[:k]
        if t:
            lo, hi = fm.back(seq[last[:k] - t], *fm.widen(lo))
        many = np.flatnonzero(hi - lo >= 2)
        if len(many):
            low = fm.earliest(lo[many])
            own = key[last[many] - t]
            dup = many[low < own]
            found_s.append(order[dup])
            found_w.append(sizes[order[dup]] - 1 - t)
    if not found_s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_s), np.concatenate(found_w)


def search(routed: DataFrame, shards: int, n: int) -> DataFrame:
    """The ranges of windows that stand earlier too: those found in each shard, and those known before."""

    def run(batches):
        current, rows = None, []
        for batch in batches:
            known = pc.is_null(batch.column("words"))
            done = batch.filter(known)
            if done.num_rows:
                yield pa.RecordBatch.from_arrays(done.columns[:4], names=FIELDS[:4])
            for row in batch.filter(pc.invert(known)).select(FIELDS[4:]).to_pylist():
                if row["shard"] != current:
                    yield from found(rows)
                    current, rows = row["shard"], []
                rows.append(row)
        yield from found(rows)

    def found(rows):
        if rows:
            get = lambda c, t: np.concatenate([np.frombuffer(r[c], t) for r in rows])  # noqa: B023, E731
            ids, hs, starts, sizes = get("ids", "<i8"), get("hs", "<i8"), get("starts", "<i4").astype(np.int64), get("counts", "<i4").astype(np.int64)
            five = get("words", np.uint8).reshape(-1, 5)
            words = np.zeros((len(five), 8), np.uint8)
            words[:, :5] = five
            words = words.view("<u8")[:, 0]
            length = sizes + n - 1
            first = np.cumsum(length) - length
            d1, d2 = digests(W.mix(words), first, first + length)
            order = np.lexsort((starts, ids, d2, d1))
            new = np.ones(len(order), bool)
            a, b = order[1:], order[:-1]
            new[1:] = (d1[a] != d1[b]) | (d2[a] != d2[b])
            which = np.cumsum(new) - 1
            lead = order[new]
            later = (ids[order] != ids[lead][which]) | (starts[order] != starts[lead][which])
            out = [(ids[order[later]], hs[order[later]], starts[order[later]], sizes[order[later]])]
            at = np.repeat(first[lead], length[lead]) + np.arange(length[lead].sum()) - np.repeat(np.cumsum(length[lead]) - length[lead], length[lead])
            s, w = repeats(ids[lead], starts[lead], sizes[lead], words[at], n)
            # Runs of windows, then one range for each row that shares the leading place.
            by = np.lexsort((w, s))
            s, w = s[by], w[by]
            if len(s):
                edge = np.ones(len(s), bool)
                edge[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1] + 1)
                begin = np.flatnonzero(edge)
                many = np.diff(np.append(begin, len(s)))
                for extra in (False, True):
                    rows_of = order[~later & (new != extra)]
                    seg = which[~later & (new != extra)]
                    if not len(rows_of):
                        continue
                    lo, hi = np.searchsorted(s[begin], seg, "left"), np.searchsorted(s[begin], seg, "right")
                    k = hi - lo
                    r = np.repeat(rows_of, k)
                    run_ = np.repeat(lo, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                    out.append((ids[r], hs[r], starts[r] + w[begin[run_]], many[run_]))
            for i, h, st, m in out:
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(h), pa.array(st.astype(np.int32)), pa.array(m.astype(np.int32))], names=["id", "h", "start", "windows"])

    # Shards come one after another to a task, so it holds one of them however many there are.
    tasks = min(shards, MOST_TASKS)
    return routed.repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard").mapInArrow(run, RANGES)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, k: int = K, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, text, ranges): every row with its ranges (first window, windows) of windows that stand earlier too, or null."""
    spark = docs.sparkSession
    reach_workers(spark)
    own = docs.select(F.col(id_col).cast("long").alias("given"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"), F.col(text_col).alias("text"))
    total = own.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shards = 1 << max(4, math.ceil(math.log2(max(total / shard_bytes, 1))))
    with small_batches(spark, 2000):
        bits = spark.sparkContext.broadcast(minimizer_filter(own, filters.shape_for(total), n, k))
        found = staged(search(route(own, bits, shards, n, k), shards, n), "ranges")
    ranges = found.distinct().groupBy("id", "h").agg(F.collect_list(F.struct("start", "windows")).alias("ranges"))
    out = own.join(ranges, ["id", "h"], "left")
    return out.select(F.col("given").alias("doc_id"), "text", "ranges")


def cut(found: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the kept words of each document joined by one space."""

    def run(batches):
        for batch in batches:
            ranges = batch.column("ranges")
            for lo, hi, data, docs in W.slices(batch.column("text")):
                w = W.find(data, docs, W.SPACED_MASK, hashed=False)
                raw, n_removed, kept = data.tobytes(), [], []
                for d, gone in enumerate(ranges.slice(lo, hi - lo).to_pylist()):
                    words = raw[docs[d] : docs[d + 1]].split()
                    removed = 0
                    if gone:
                        edge = np.zeros(len(words) + 1, np.int32)
                        for r in gone:
                            edge[r["start"]] += 1
                            edge[r["start"] + r["windows"] + n - 1] -= 1
                        stay = np.cumsum(edge[:-1]) == 0
                        removed = int(len(stay) - stay.sum())
                        words = [x for x, s in zip(words, stay.tolist(), strict=True) if s]
                    n_removed.append(removed)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(w.of).astype(np.int64)), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return found.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    return cut(find_repeats(docs, id_col, text_col, n), n)


