"""Approximate nearest neighbours by adaptive dimension scan over probed lists.

Nearness is the largest inner product. Vectors are dealt to lists by k-means (fitted on a bounded sample); a query probes
its nearest lists. Inside a list, vectors are rotated by one random orthogonal matrix, so that partial squared distances
over a block of columns estimate the whole; after each block a candidate is given up when its partial distance exceeds
what the distance to beat allows at that depth, by a test with significance set by `epsilon`. Survivors are scored
exactly, in double precision, on the original vectors. The distance to beat is known before any list is read: the k-th
best of the query among at most a SHARE-th of all vectors, taken from the sample; it bounds the search and gives no results.
A query for which the scan finds fewer than k is asked again of all lists without tests.

How many lists are probed is fitted: the fewest for which the sample's own neighbours are found to `aim`. Data without
clusters need about half of the lists.

Defined results: null ids, and vectors that are null, zero, of another dimension than most of the sample, or hold null or
non-finite components, take no part; rows with the query's id are its own; repeated ids count once, at their best score;
ties go to the smaller id; an empty table gives an empty result; other columns are not carried.

Scale: centroids and sample (at most `sample_bytes`) are broadcast. Small lists are put together, large ones cut by a hash of
the id, into bins of about `chunk_rows`, so a hot list is many tasks' work and a query is sent once to each bin that holds one
of its lists; the queries of a bin come in blocks of about `block_queries`. No task holds more than one bin and one block.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from zonalith.llm import words as W
from zonalith.session import reach_workers, staged

SAMPLE_ROWS, SAMPLE_BYTES, SHARE = 8_192, 16 << 20, 3
CHUNK_ROWS, BLOCK_QUERIES, BLOCKS, CHUNK_BYTES, MOST_TASKS = 2048, 32_768, 4, 8 << 20, 1 << 14
EPSILON, AIM = 2.1, 0.97


class Index(NamedTuple):
    centroids: np.ndarray
    first: np.ndarray  # the first bin of each list
    chunks: np.ndarray  # how many bins each list has
    bins: int
    probes: int
    beat_ids: np.ndarray
    beat: np.ndarray  # the vectors that set the distance to beat
    rotation: np.ndarray
    k: int
    query_blocks: int


def matrix(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors as float64)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros(0, np.int64), np.zeros((0, dim or 0))
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float), nan=-1.0).astype(np.int64)
    if dim is None:
        real = lengths[lengths > 0]
        dim = int(np.bincount(real).argmax()) if len(real) else 0
    rows = np.flatnonzero(lengths == dim)
    if not dim or not len(rows):
        return np.zeros(0, np.int64), np.zeros((0, dim))
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    ok = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
    return rows[ok], flat[ok]


def nearest_lists(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)


def fit(ids: np.ndarray, x: np.ndarray, total: int, queries: int, k: int, chunk_rows: int, block_queries: int, aim: float, seed: int) -> Index:
    rng = np.random.default_rng(seed)
    n, dim = x.shape
    lists = 1 if n < 1024 else max(1, min(int(math.sqrt(total)), n // 16))
    c = x[rng.choice(n, lists, replace=False)].copy() if n else np.zeros((1, dim))
    for _ in range(8 if lists > 1 else 0):
        a = nearest_lists(x, c)
        size = np.bincount(a, minlength=lists)
        total_of = np.zeros_like(c)
        np.add.at(total_of, a, x)
        c[size > 0] = total_of[size > 0] / size[size > 0, None]
    a = nearest_lists(x, c) if n else np.zeros(0, np.int64)
    share = np.bincount(a, minlength=lists) / max(n, 1)
    chunks = np.maximum(1, np.ceil(share * total / chunk_rows)).astype(np.int64)
    probes = 1
    if lists > 1:
        q = rng.choice(n, min(256, n), replace=False)
        s = x[q] @ x.T
        s[np.arange(len(q)), q] = -np.inf
        top = a[np.argpartition(-s, k, axis=1)[:, :k]]
        rank = np.argsort(np.argsort(-(x[q] @ c.T), axis=1), axis=1)
        needed = np.sort(np.take_along_axis(rank, top, axis=1).ravel())
        probes = min(lists, int(needed[min(len(needed) - 1, math.ceil(aim * len(needed)))]) + 1)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0] if dim else np.zeros((0, 0))
    first, at, held = np.zeros(lists, np.int64), 0, 0.0
    for j in range(lists):
        rows = share[j] * total
        if held and (chunks[j] > 1 or held + rows > chunk_rows):
            at, held = at + 1, 0.0
        first[j] = at
        if chunks[j] > 1:
            at += int(chunks[j])
        else:
            held += max(rows, 1.0)
    few = np.sort(rng.choice(n, min(n, total // SHARE), replace=False))
    return Index(c, first, chunks, int(at + (held > 0)), probes, ids[few], x[few], rotation, k, max(1, math.ceil(queries / block_queries)))


def probed(q: np.ndarray, index: Index) -> np.ndarray:
    """For each query and list, whether the query probes it."""
    near = np.argsort(-(q @ index.centroids.T), axis=1, kind="stable")[:, : index.probes]
    out = np.zeros((len(q), len(index.centroids)), bool)
    np.put_along_axis(out, near, True, axis=1)
    return out


def scan(x: np.ndarray, xid: np.ndarray, q: np.ndarray, qid: np.ndarray, beat: np.ndarray, index: Index, epsilon: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best of a bin that reach the score to beat, list by list against the queries that probe
    it. epsilon: None for all lists and no tests."""
    dim, out = x.shape[1], []
    edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
    of = nearest_lists(x, index.centroids) if len(x) else np.zeros(0, np.int64)
    order = np.argsort(of, kind="stable")
    x, xid, of = x[order], xid[order], of[order]
    xr, xx = x @ index.rotation, (x * x).sum(axis=1)
    cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(of)) + 1, np.arange(0, len(x), 512), [len(x)]]))
    for lo in range(0, len(q), 512):
        part, pid, least = q[lo : lo + 512], qid[lo : lo + 512], beat[lo : lo + 512]
        qr, qq = part @ index.rotation, (part * part).sum(axis=1)
        asks = probed(part, index) if epsilon is not None else None
        found = []
        for c0, c1 in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            who = np.flatnonzero(asks[:, of[c0]]) if asks is not None else np.arange(len(part))
            if not len(who):
                continue
            i, j = survivors(qr[who], qq[who], least[who], xr[c0:c1], xx[c0:c1], edges, epsilon)
            i, j = who[i], j + c0
            score = (part[i] * x[j]).sum(axis=1)
            keep = (score >= least[i]) & (pid[i] != xid[j])
            found.append((i[keep], j[keep], score[keep]))
        if not found:
            continue
        i, j, score = (np.concatenate(c) for c in zip(*found, strict=True))
        # Repeated rows of an id count once, at their best score, before the cut.
        order = np.lexsort((-score, xid[j], i))
        i, j, score = i[order], j[order], score[order]
        once = np.ones(len(i), bool)
        once[1:] = (i[1:] != i[:-1]) | (xid[j[1:]] != xid[j[:-1]])
        i, j, score = i[once], j[once], score[once]
        order = np.lexsort((xid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        keep = nth < index.k
        out.append((pid[i[keep]], xid[j[keep]], score[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(p) for p in zip(*out, strict=True))


def survivors(qr: np.ndarray, qq: np.ndarray, beat: np.ndarray, xr: np.ndarray, xx: np.ndarray, edges: np.ndarray, epsilon: float | None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (query, candidate) that no test after a block of columns gives up."""
    if epsilon is None:
        i, j = np.nonzero(np.ones((len(qr), len(xr)), bool))
        return i, j
    dim = int(edges[-1])
    a, b = edges[0], edges[1]
    most = qq[:, None] + xx - 2 * beat[:, None] + 1e-9
    gap = (qr[:, a:b] ** 2).sum(axis=1)[:, None] + (xr[:, a:b] ** 2).sum(axis=1) - 2 * qr[:, a:b] @ xr[:, a:b].T
    i, j = np.nonzero(gap <= most * (b / dim) * (1 + epsilon / math.sqrt(b)) ** 2)
    gap, most = gap[i, j], most[i, j]
    for a, b in zip(edges[1:-1], edges[2:], strict=True):
        d = qr[i, a:b] - xr[j, a:b]
        gap = gap + np.einsum("ij,ij->i", d, d)
        keep = gap <= (most * (b / dim) * (1 + epsilon / math.sqrt(b)) ** 2 if b < dim else most + 1e-9)
        i, j, gap, most = i[keep], j[keep], gap[keep], most[keep]
    return i, j


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", chunk_rows: int = CHUNK_ROWS, block_queries: int = BLOCK_QUERIES, epsilon: float = EPSILON, aim: float = AIM, seed: int = 53) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where is_query (a condition on id_col) holds, against all rows."""
    spark = vectors.sparkSession
    reach_workers(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null")
    total, queries, dim = own.agg(F.count("*"), F.count_if("q"), F.max(F.size("v"))).first()
    rows = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(dim or 1, 1))))
    sample = own.select("id", "v").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(rows).toArrow()
    at, x = matrix(sample.column("v"))
    ids = sample.column("id").to_numpy()[at]
    ids, once = np.unique(ids, return_index=True)
    chunk_rows = max(64, min(chunk_rows, CHUNK_BYTES // (8 * max(dim or 1, 1))))
    index = fit(ids, x[once], total, queries, k, chunk_rows, block_queries, aim, seed)
    shared = spark.sparkContext.broadcast(index)
    dim = index.beat.shape[1]

    kind = "<f4" if "float" in own.schema["v"].dataType.simpleString() else "<f8"

    def out(key, asks, ids, x, beat):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(asks), pa.array(ids), pa.array([v.tobytes() for v in x.astype(kind)], pa.binary()), pa.array(beat)], names=NAMES)

    def deal(whole: bool):
        """Rows of (key, is query, id, vector, score to beat) for each bin and block; whole: queries alone, to every bin, with nothing to beat."""

        def run(batches):
            ix = shared.value
            for batch in batches:
                at, x = matrix(batch.column("v"), dim)
                if not len(at):
                    continue
                ids = batch.column("id").to_numpy()[at]
                asks = batch.column("q").to_numpy(zero_copy_only=False)[at]
                if not whole:
                    mine = nearest_lists(x, ix.centroids)
                    salt = W.mix(ids.astype(np.uint64)) >> np.uint64(8)
                    key = (ix.first[mine] + (salt % ix.chunks[mine].astype(np.uint64)).astype(np.int64)) * ix.query_blocks
                    for b in range(ix.query_blocks):
                        yield out(key + b, np.zeros(len(ids), bool), ids, x, np.zeros(len(ids)))
                where = np.flatnonzero(asks)
                for lo in range(0, len(where), 64):
                    q, qid = x[where[lo : lo + 64]], ids[where[lo : lo + 64]]
                    beat = np.full(len(q), -np.finfo(float).max / 8)
                    to = np.ones((len(q), ix.bins), bool)
                    if not whole:
                        s = q @ ix.beat.T
                        s[qid[:, None] == ix.beat_ids] = -np.inf
                        n = s.shape[1]
                        kth = np.partition(s, n - ix.k, axis=1)[:, n - ix.k] if n >= ix.k else np.full(len(q), -np.inf)
                        # Room for the last bits, in which this product and the exact score may differ.
                        beat = np.where(np.isfinite(kth), kth - 1e-9 * np.abs(kth) - 1e-12, beat)
                        i, lists = np.nonzero(probed(q, ix))
                        per = ix.chunks[lists]
                        to[:] = False
                        to[np.repeat(i, per), np.repeat(ix.first[lists], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)] = True
                    block = (W.mix(qid.astype(np.uint64)) % np.uint64(ix.query_blocks)).astype(np.int64)
                    of, bins = np.nonzero(to)
                    yield out(bins * ix.query_blocks + block[of], np.ones(len(of), bool), qid[of], q[of], beat[of])

        return run

    def probe(tests: float | None):
        def run(table: pa.Table) -> pa.Table:
            asks = table.column("asks").to_numpy(zero_copy_only=False)
            ids, beat = table.column("id").to_numpy(), table.column("beat").to_numpy()
            x = np.frombuffer(b"".join(table.column("v").to_pylist()), kind).reshape(len(ids), dim).astype(np.float64)
            qid, xid, score = scan(x[~asks], ids[~asks], x[asks], ids[asks], beat[asks], shared.value, tests)
            return pa.table({"query_id": qid, "vec_id": xid, "score": score})

        return run

    dealt = staged(own.mapInArrow(deal(False), DEALT), "lists")
    # A task for each bin and block, however small: the work is in the pairs, not in the bytes that are moved.
    tasks = min(MOST_TASKS, index.bins * index.query_blocks)
    hits = staged(dealt.repartition(tasks, "key").groupBy("key").applyInArrow(probe(epsilon), HITS), "hits")
    # Queries with fewer than k found go to all lists, without tests.
    found = hits.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
    asked = dealt.where("asks").select(F.col("id").alias("query_id")).distinct()
    short = staged(asked.join(found, "query_id", "left").where(F.coalesce("n", F.lit(0)) < k).select(F.col("query_id").alias("id")), "short")
    if not short.isEmpty():
        again = own.where("q").join(short, "id", "left_semi").select("id", "v", "q").mapInArrow(deal(True), DEALT)
        hits = hits.unionByName(dealt.where("not asks").unionByName(again).repartition(tasks, "key").groupBy("key").applyInArrow(probe(None), HITS))
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


NAMES = ["key", "asks", "id", "v", "beat"]
DEALT = "key long, asks boolean, id long, v binary, beat double"
HITS = "query_id long, vec_id long, score double"
