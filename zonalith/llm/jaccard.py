"""N-gram Jaccard join: documents whose sets of word n-grams have a similarity of at least 80 / 100, and their components.

Words are runs of anything but ASCII white space, A-Z lower-cased. A document's set holds its distinct n-word shingles;
with fewer words, the whole sequence as one; without words nothing, and it links with nothing. Shingles are 64-bit
hashes; documents of equal sets are one node from the start (a set is told by 64 bits of all its shingles).

Method. All shingles stand in one global order: those of one document alone, then the others, rare before frequent, then
by hash. What stands in several documents is told by a bit filter, frequency by a count sketch, both over all documents. Sets
that reach the threshold share a shingle among the first n - ceil(0.8 n) + 1 of each, so only nodes under a common prefix
shingle are compared, and of those only pairs that can still share enough from there on. They are compared by a prefix-tree
join: the ordered sets, most frequent first so that copies share their paths, are stored in tries - sorted lists with the depth
each shares with the one before - built once and walked by many probing sets. Overlaps counted on a shared path are kept, and
a subtree is left as soon as what remains of its sets cannot reach the overlap needed. Every link is decided on whole sets.

Within a prefix group not all pairs are tried. The group's first nodes probe all others, linked nodes are joined into
components, and only groups that still hold several components go on, with four times as many probes, until none is left: a
pair is skipped only when its two nodes are connected already, so components are exact.

Defined results: null text has no words; repeated rows and equal ids are documents of their own that share a node;
documents without words, or with a null id, keep their own id as component unless linked; an empty table gives an empty
result; very long texts are sets like others; other columns are not carried.

Scale: texts are never shuffled; each pass reads them where they are and hashes anew. The sketch (2 ** SKETCH_BITS
counters) and the bit filters are of bounded size; a full filter only lets more through.
Copies are one node, emitted once by each task. Tries hold about `chunk` sets. Members of a hot shingle are dealt over SALTS tasks.
A round's links are contracted to links between components before these are joined.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from zonalith.llm import filters, words as W
from zonalith.llm.graph import components
from zonalith.session import drop_staged, reach_workers, small_batches, staged

N, NUM, DEN = 5, 80, 100
SKETCH_BITS, SLICE_BITS = 21, 15
CHUNK, SALTS = 256, 8
U64 = np.uint64
#: Columns beside those of the documents.
NODE, RANK = "jaccard node", "jaccard rank"


def sets_of(column: pa.Array, n: int):
    """(row, set) of each text: its distinct shingle hashes, sorted."""
    for lo, hi, data, docs in W.slices(column):
        w = W.find(data, docs, W.SPACED_MASK, lower=True)
        g = W.grams(w.hash, n)
        counts = np.diff(w.of).tolist()
        for d, (a, c) in enumerate(zip(w.of[:-1].tolist(), counts, strict=True)):
            if c >= n:
                yield lo + d, np.unique(g[a : a + c - n + 1])
            elif c:
                # The whole sequence as one; the number of words keeps it apart from longer ones.
                yield lo + d, W.mix(W.grams(w.hash[a : a + c], c) + U64(c))
            else:
                yield lo + d, np.zeros(0, U64)


def node_of(s: np.ndarray) -> int:
    """64 bits of a whole set, as a signed number."""
    return int(W.mix(np.array([W.mix(s ^ U64(0xA0761D6478BD642F)).sum(dtype=U64) + U64(len(s))], dtype=U64)).view(np.int64)[0])


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass: (id, node, n) of each document and, with a null node, (slice, counts) of the task's sketch."""

    def run(batches):
        counts, seen = np.zeros(1 << SKETCH_BITS, np.uint32), set()
        for batch in batches:
            nodes, sizes = [], []
            for _, s in sets_of(batch.column("text"), n):
                node = node_of(s) if len(s) else 0
                nodes.append(node)
                sizes.append(len(s))
                if len(s) and node not in seen:
                    seen.add(node)
                    np.add.at(counts, (s >> U64(64 - SKETCH_BITS)).astype(np.int64), 1)
            rows = len(nodes)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=["id", "node", "n", "slice", "counts"])
        if seen:
            parts = counts.reshape(-1, 1 << SLICE_BITS)
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(range(k), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=["id", "node", "n", "slice", "counts"])

    return docs.mapInArrow(run, "id long, node long, n long, slice int, counts binary")


def levels_of(sketch: DataFrame) -> np.ndarray:
    """Quarter-octave frequency levels of the sketch's counters, summed over all tasks."""

    def add(batches):
        sums = {}
        for batch in batches:
            for s, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(c), np.uint32)
                sums[s] = sums[s] + part if s in sums else part.astype(np.uint64)
        if sums:
            made = [np.floor(4 * np.log2(np.maximum(v, 1))).astype(np.uint8).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(made, pa.binary())], names=["slice", "level"])

    parts = 1 << (SKETCH_BITS - SLICE_BITS)
    got = sketch.repartition(parts, "slice").mapInArrow(add, "slice int, level binary").collect()
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for s, level in got:
        out[s << SLICE_BITS : (s + 1) << SLICE_BITS] = np.frombuffer(level, np.uint8)
    return out


def ordered(s: np.ndarray, order: tuple) -> np.ndarray:
    """A set in the global order, rare first: shingles that stand in one node alone, then by frequency level, then by hash."""
    levels, several = order
    level = levels[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int16) + 1
    level[~filters.inside(several, s)] = 0
    return s[np.argsort(level, kind="stable")]


def several_filter(docs: DataFrame, shape: filters.Shape, n: int) -> np.ndarray:
    """Bits of all shingles that stand in two documents or more, those of a task's equal sets once."""

    def emit(batches):
        seen, packer = set(), filters.Packer(shape)
        for batch in batches:
            for _, s in sets_of(batch.column("text"), n):
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    if packer.add(s):
                        yield from packer.flush()
        if packer.held:
            yield from packer.flush()

    return filters.shared_bits(docs.mapInArrow(emit, filters.PACKED), shape)


def prefix_filter(docs: DataFrame, order, shape: filters.Shape, n: int) -> np.ndarray:
    """Bits of the shingles that stand in the prefixes of two nodes or more."""

    def emit(batches):
        seen, packer = set(), filters.Packer(shape)
        for batch in batches:
            for _, s in sets_of(batch.column("text"), n):
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    p = ordered(s, order.value)[: prefix_length(len(s))]
                    p = p[filters.inside(order.value[1], p)]
                    if len(p) and packer.add(p, np.full(len(p), node, np.int64)):
                        yield from packer.flush()
        if packer.held:
            yield from packer.flush()

    return filters.shared_bits(docs.mapInArrow(emit, filters.PACKED), shape)


def candidates(docs: DataFrame, order, bits, n: int) -> DataFrame:
    """(node, n, tokens, places, set) of the nodes with a prefix shingle in the filter: those shingles, where they stand, and the
    whole set, most frequent first."""

    def run(batches):
        seen = set()
        for batch in batches:
            rows: list[tuple] = []
            for _, s in sets_of(batch.column("text"), n):
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                seen.add(node)
                s = ordered(s, order.value)
                p = s[: prefix_length(len(s))]
                at = np.flatnonzero(filters.inside(order.value[1], p) & filters.inside(bits.value, p))
                if len(at):
                    rows.append((node, len(s), p[at].view(np.int64).tolist(), at.tolist(), s[::-1].tobytes()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["node", "n", "tokens", "places", "set"])

    return docs.mapInArrow(run, "node long, n long, tokens array<long>, places array<long>, set binary")


class Trie:
    """Sets of shingles in one order, as a prefix tree: sorted, each with the depth it shares with the one before."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].tobytes())
        self.sets = [sets[k] for k in self.order]
        self.place = {k: i for i, k in enumerate(self.order)}
        self.shared = [0] * len(sets)
        for i in range(1, len(sets)):
            x, y = self.sets[i - 1], self.sets[i]
            m = min(len(x), len(y))
            other = np.flatnonzero(x[:m] != y[:m])
            self.shared[i] = int(other[0]) if len(other) else m

    def walk(self, probe: np.ndarray, wanted: list[int]) -> list[int]:
        """Those of the wanted sets (numbers as given) that reach the threshold with the probing set. Overlaps counted on a shared
        path are taken over; a path is left as soon as what remains of its sets cannot reach the overlap needed."""
        mine, found = np.sort(probe), []
        count, dead, last = np.zeros(1, np.int64), None, -1
        for i in sorted(self.place[k] for k in wanted):
            y = self.sets[i]
            depth = min(self.shared[last + 1 : i + 1]) if last >= 0 else 0
            last = i
            need = -(-NUM * (len(mine) + len(y)) // (NUM + DEN))
            # `dead`: the depth at which the last path was left.
            if dead is not None and depth >= dead and count[dead] + len(y) - dead < need:
                continue
            depth = min(depth, len(count) - 1)
            count, at, dead = count[: depth + 1], depth, None
            while at < len(y):
                if count[at] + len(y) - at < need:
                    dead = at
                    break
                part = y[at : at + 64]
                place = np.minimum(np.searchsorted(mine, part), len(mine) - 1)
                count = np.concatenate([count, count[at] + np.cumsum(mine[place] == part)])
                at += len(part)
            if at >= len(y) and count[len(y)] >= need:
                found.append(self.order[i])
        return found


def verify(pairs: DataFrame, sets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The links (a, b) among distinct pairs (a, b). The sets b that have the same first probe are stored in tries of about `chunk`
    sets, each built once and walked by all the probes of its sets; a set is sent to one trie, a probe once to each."""
    own = pairs.groupBy("b").agg(F.min("a").alias("home"), F.sort_array(F.collect_list("a")).alias("probes"))
    homes = own.groupBy("home").agg(F.count("*").alias("k"))
    own = own.join(homes, "home").withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / chunk))).drop("k")
    asks = own.select("home", "part", F.explode("probes").alias("a")).distinct().join(sets.select(F.col("node").alias("a"), "set"), "a")
    asks = asks.select("home", "part", F.lit(True).alias("asks"), F.col("a").alias("node"), F.lit(None).cast("array<long>").alias("probes"), "set")
    stored = own.join(sets.select(F.col("node").alias("b"), "set"), "b").select("home", "part", F.lit(False).alias("asks"), F.col("b").alias("node"), "probes", "set")
    rows = stored.unionByName(asks).repartition("home", "part").sortWithinPartitions("home", "part", "asks", "node")

    def run(batches):
        where, names, sets, wanted, trie = None, [], [], {}, None
        for batch in batches:
            found_a, found_b = [], []
            for home, part, asks, node, probes, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (home, part) != where:
                    where, names, sets, wanted, trie = (home, part), [], [], {}, None
                s = np.frombuffer(s, U64)
                if not asks:
                    for a in probes:
                        wanted.setdefault(a, []).append(len(names))
                    names.append(node)
                    sets.append(s)
                    continue
                trie = trie or Trie(sets)
                hit = trie.walk(s, wanted[node])
                found_a += [node] * len(hit)
                found_b += [names[k] for k in hit]
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def salted(by_token: DataFrame) -> DataFrame:
    """A table of a few rows a token, once for each salt: a hot token's members are dealt over SALTS tasks."""
    return by_token.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


def live(groups: DataFrame) -> DataFrame:
    """Groups that still hold several components, with those members that can link. A member whose shingle stands at `place` can
    share n - place shingles at most, so its partner has at most `most` shingles; of two that link, the smaller is `strong`
    (most >= n), and the other has room for it."""
    least = groups.groupBy("token").agg(F.min(F.when(F.col("most") >= F.col("n"), F.col("n"))).alias("least"))
    own = groups.join(salted(least), ["token", "salt"]).where("most >= n or most >= least").drop("least")
    open_ = own.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.bool_or(F.col("most") >= F.col("n")).alias("ok")).where("x < y and ok").select("token")
    return own.join(salted(open_), ["token", "salt"], "left_semi")


def grown(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) with the new links: these are contracted to links between components first, so only what they join is worked on."""
    if comp is None:
        return components(links)
    of = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = staged(ends.select("a", "b", F.coalesce("a_comp", "a").alias("x"), F.coalesce("b_comp", "b").alias("y")), "ends")
    roots = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    new = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comp, "node", "left_anti").withColumn("comp", F.col("node"))
    every = comp.unionByName(new).join(roots.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp", "left")
    return every.select("node", F.coalesce("root", "comp").alias("comp"))


def link_nodes(sets: DataFrame, groups: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, comp) of the linked nodes. groups: (token, node, n, place) of prefix shingles that several nodes share."""
    most = F.floor((NUM + DEN) * (F.col("n") - F.col("place")) / NUM) - F.col("n")
    comp, probes = None, 4
    groups = groups.withColumn("most", most).withColumn("comp", F.col("node")).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    groups = staged(live(groups), "groups")
    while True:
        # Each group's probes: of each of `probes` hash classes the strong member with fewest shingles, nearest the front.
        lead = groups.where("most >= n").withColumn("class", F.pmod(F.xxhash64("node"), F.lit(probes)))
        lead = lead.groupBy("token", "class").agg(F.min(F.struct("n", "place", "node", "comp", "most")).alias("p"))
        lead = lead.select("token", F.col("p.node").alias("a"), F.col("p.n").alias("an"), F.col("p.comp").alias("ac"), F.col("p.most").alias("am"))
        pairs = groups.join(salted(lead), ["token", "salt"]).where("comp <> ac and n <= am and an <= most").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        pairs = staged(pairs.distinct(), "pairs")
        links = staged(verify(pairs, sets, chunk), "links")
        drop_staged(pairs)
        old_comp, comp = comp, staged(grown(comp, links), "components")
        # What the probes have been held against is done; the others go on while they are not all connected.
        done = salted(lead.select("token", F.col("a").alias("node")).distinct())
        rest = groups.drop("comp").join(done, ["token", "salt", "node"], "left_anti")
        rest = live(rest.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
        old, groups = groups, staged(rest, "groups")
        for used in (old, links, old_comp):
            if used is not None:
                drop_staged(used)
        if groups.isEmpty():
            return comp
        probes *= 4


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, comp): one row for each document; component_id is the smallest id reachable, comp the
    smallest node, which tells components of rows that share an id apart."""
    spark = docs.sparkSession
    reach_workers(spark)
    with small_batches(spark, 2000):
        return _join(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), n, chunk)


def _join(own: DataFrame, n: int, chunk: int) -> DataFrame:
    spark = own.sparkSession
    seen = staged(survey(own, n), "survey")
    rows = seen.where("slice is null").select("id", "node", "n")
    total = own.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shape = filters.shape_for(total)
    levels = levels_of(seen.where("slice is not null").select("slice", "counts"))
    order = spark.sparkContext.broadcast((levels, several_filter(own, shape, n)))
    bits = spark.sparkContext.broadcast(prefix_filter(own, order, shape, n))
    made = staged(candidates(own, order, bits, n), "candidates")
    found = staged(made.dropDuplicates(["node"]), "sets")
    drop_staged(made)
    groups = found.select(F.explode(F.arrays_zip("tokens", "places")).alias("t"), "node", "n")
    groups = groups.select(F.col("t.tokens").alias("token"), "node", "n", F.col("t.places").alias("place"))
    least = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    comp = link_nodes(found.select("node", "set"), groups, chunk)
    least = least.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    of_comp = least.groupBy("comp").agg(F.min("least").alias("component"))
    least = least.join(of_comp, "comp").select("node", "component", "comp")
    out = rows.join(least, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(F.col("n") > 0, F.col("node")).alias("node"), F.when(F.col("n") > 0, F.col("comp")).alias("comp"))


def keep_one(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """One row for each component: of its rows of the smallest id, that of the smallest node, and of equal ones the first by text
    and other columns. Documents without words and with null ids stay. An id of one row is decided by the id alone; rows that
    share an id are told apart by their node, for which only their texts are hashed again."""
    known = joined.where("doc_id is not null")
    many = staged(known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias(id_col)), "repeated")
    gone = known.where("n_shingles > 0 and doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    if many.isEmpty():
        return docs.join(gone, id_col, "left_anti")
    single = docs.join(gone.unionByName(many).distinct(), id_col, "left_anti")
    first = known.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("doc_id", "node")).alias("w"))
    first = first.select(F.col("w.doc_id").alias(id_col), F.col("w.node").alias(NODE)).join(many, id_col, "left_semi")

    @F.arrow_udf("long")
    def node(text: pa.Array) -> pa.Array:
        return pa.array([node_of(s) if len(s) else None for _, s in sets_of(text, n)], pa.int64())

    shared = docs.join(many, id_col, "left_semi").withColumn(NODE, node(text_col))
    rest = F.to_json(F.struct(*[c for c in docs.columns if c not in (id_col, text_col)], F.lit(0).alias(NODE)))
    order = Window.partitionBy(id_col, NODE).orderBy(text_col, rest)
    chosen = shared.join(first, [id_col, NODE], "left_semi").withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) == 1)
    return single.unionByName(shared.where(F.col(NODE).isNull()).select(*docs.columns)).unionByName(chosen.select(*docs.columns))
