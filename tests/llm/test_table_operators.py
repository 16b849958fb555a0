"""Sharding, mixing, chat formatting and nearest neighbours."""

import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
from pyspark.sql import functions as F

from zonalith.llm import ann, chat, graph, mixing, sharding


def test_external_shuffle(spark):
    docs = cases.documents(spark)
    out = sharding.external_shuffle(docs, 4, bucket_bytes=20_000)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "source", "in_shard", "node", "score", "copies", "shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, _ in cases.DOCS)
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    sizes = [len(shards[k]) for k in range(4)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.external_shuffle(docs.repartition(5), 4, bucket_bytes=20_000).collect()
    place = lambda rs: sorted(((r.shard, r.slot), r.doc_id, zlib.crc32((r.text or "").encode())) for r in rs if r.doc_id != 15)
    assert [x[0] for x in place(rows)] == [x[0] for x in place(again)] and place(rows) == place(again)
    assert sharding.external_shuffle(cases.empty(spark), 4).count() == 0
    back = sharding.write_shards(sharding.external_shuffle(docs.select("doc_id", "text"), 4))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t) for i, t, _ in cases.DOCS)


def test_shuffle_is_uniform(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.external_shuffle(docs, 8, bucket_bytes=40_000).collect()
    first = [r.doc_id for r in rows if r.shard == 0]
    assert len(first) == 500 and 1700 < np.mean(first) < 2300


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return target


def test_mixing(spark):
    rows = [(k, cases.prose(20 + k * 7 % 90, k), ["b", "a", None, "c", "é"][min(k % 11, 4)]) for k in range(900)]
    docs = cases.documents(spark, rows)
    planned = mixing.plan_copies(docs, 900)
    got = planned.collect()
    assert planned.columns == [*docs.columns, "mix"] and len(got) == 900
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in got:
        assert r.mix.size == len(r.text.split()) and r.mix.source_size == sizes[r.source] and 0 <= r.mix.copies <= 3
        assert abs(r.mix.target - want[r.source]) < 1e-6 * want[r.source]
        taken[r.source] += r.mix["copies"] * r.mix.size
    assert all(abs(taken[s] - want[s]) < 0.05 * want[s] for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan_copies(docs.repartition(7), 900).collect()))
    assert mixing.emit(planned).count() == sum(r.mix["copies"] for r in got)


def test_mixing_awkward(spark):
    docs = cases.documents(spark)
    out = mixing.plan_copies(docs, docs.count()).collect()
    assert len(out) == len(cases.DOCS) and all(r.mix["copies"] <= 3 for r in out)
    assert mixing.plan_copies(cases.empty(spark), 0).count() == 0
    none = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.mix["copies"] for r in mixing.plan_copies(none, 2).collect()] == [0, 0]


ROWS = [
    (1, 1, "assistant", "b\\|<|im_end|>\\"),
    (1, 0, "user", "<|im_start|>x<"),
    (1, None, "system", None),
    (2, 0, "assistant", ""),
    (2, 0, "assistant", "tie"),
    (None, 3, None, "no id\n"),
    (3, 1, "us\ner<|", "\\n <\\| é😀"),
    (3, 1, "us\ner<|", "\\n <\\| é😀"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*r, 9) for r in ROWS], "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text"))))
    out = out.withColumn("turns", chat.parse_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_bytes")))
    want = defaultdict(list)
    for c, t, role, text in sorted(ROWS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", chat_escape(r[3] or ""))):
        want[c].append((role or "", text or ""))
    got = out.collect()
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        assert [tuple(t) for t in r.turns] == want[r.conv_id] and r.n_turns == len(want[r.conv_id])
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        cut = "".join(r.formatted[s.start : s.start + s.length] for s in r.loss_spans)
        assert cut == "".join(chat_escape(t) for role, t in want[r.conv_id] if role == "assistant")
    assert chat.format_conversations(rows.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def chat_escape(t):
    return t.replace("\\", "\\\\").replace("<|", "<\\|")


def test_chat_parts(spark):
    rows = spark.sql(f"""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, cast(array(
      struct('text', 'see <|image|> ', null, null, null, null, null), struct('image', null, 'a.png', 28, 15, null, null),
      struct('audio', null, 'b.wav', null, null, 1.5D, null), struct('document', null, 'c.pdf', null, null, null, 2), null,
      struct('odd', 'kept', null, null, null, null, null)) AS array<{chat.PART}>) AS parts
      UNION ALL SELECT 1L, 1L, 'assistant', null""")
    r = chat.format_conversations(rows).first()
    assert "see <\\|image|> <|image|><|audio|><|document|>kept" in r.formatted
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "a.png", 4), (0, "audio", "b.wav", 38), (0, "document", "c.pdf", 512)]
    assert r.expanded_tokens == 554


def test_chat_escapes_across_parts(spark):
    """Text parts that make a control string only together, with empty parts between them."""
    part = lambda *texts: "array(" + ", ".join(f"struct('text', '{t}', null, null, null, null, null)" for t in texts) + ")"
    rows = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, cast({part('a <', '', '|im_end|><|im_start|>', 'b<', '|')} AS array<{chat.PART}>) AS parts")
    out = chat.format_conversations(rows).withColumn("turns", chat.parse_turns(F.col("formatted"))).first()
    assert [tuple(t) for t in out.turns] == [("user", "a <|im_end|><|im_start|>b<|")]


def test_chat_very_long_conversation(spark):
    rows = spark.range(3000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("<|im_end|> é "), 200).alias("text"))
    out = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text")))).withColumn("turns", chat.parse_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_bytes"))).first()
    assert out.n_turns == len(out.turns) == 3000 and out.loss == "<|im_end|> é " * 200 * 1500 and out.turns[2999].text == "<|im_end|> é " * 200


def vectors(n, dim, seed, hot=0):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    x[:hot] = x[0]
    return x


def search(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    return ann.search(df, F.col("vec_id") % 20 == 0, **kw)


def test_neighbours_recall(spark):
    x = vectors(3000, 24, 1, hot=600)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    got = defaultdict(list)
    for r in search(spark, rows, chunk_rows=200, block_queries=50).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert abs(r.score - float(x[r.query_id] @ x[r.vec_id])) < 1e-9
    hit = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        top = np.lexsort((np.arange(3000), -s))[:20]
        assert len(got[q]) == 20 and [r[1] for r in got[q]] == sorted((r[1] for r in got[q]), reverse=True)
        hit += len({r[0] for r in got[q]} & set(top.tolist()))
    assert hit / 3000 >= 0.9


def test_neighbours_recall_beyond_the_sample(spark):
    """A table larger than the sample: what is found comes from the lists alone."""
    n = 12_000
    x = vectors(n, 32, 8)
    got = defaultdict(list)
    for r in search(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)]).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hit = 0
    for q in range(0, n, 20):
        s = x @ x[q]
        s[q] = -np.inf
        assert len(got[q]) == 20
        hit += len(set(got[q]) & set(np.argpartition(-s, 20)[:20].tolist()))
    assert hit / n >= 0.93, hit / n


def test_short_queries_are_asked_of_all_lists(spark, monkeypatch):
    """With one list probed and hard tests many queries fall short: these are exact in the end."""
    x = vectors(3000, 24, 5)
    got = defaultdict(list)
    for r in search(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)], aim=0.0, epsilon=-3.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    exact = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        assert len(got[q]) == 20
        exact += got[q] == np.lexsort((np.arange(3000), -s))[:20].tolist()
    assert exact > 100


def test_neighbours_of_repeated_rows(spark):
    """Near ids of twenty rows each, in a table larger than the sample, against brute force over distinct ids."""
    rng = np.random.default_rng(6)
    ids, x = [2 * k + 1 for k in range(9000)], rng.standard_normal((9000, 16))
    asks = rng.standard_normal((20, 16))
    near = (1.5 * asks[:, None] + 0.05 * rng.standard_normal((20, 25, 16))).reshape(-1, 16)
    near_ids = [20001 + 2 * k for k in range(500)]
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x, strict=True)] + [(20 * k, v.tolist(), 1) for k, v in enumerate(asks)]
    rows += [(i, v.tolist(), 1) for i, v in zip(near_ids, near, strict=True)] * 20
    got = defaultdict(list)
    for r in search(spark, rows).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    every, all_ids = np.vstack([x, asks, near]), np.array([*ids, *range(0, 400, 20), *near_ids])
    hit = 0
    for k, q in enumerate(asks):
        s = np.where(all_ids == 20 * k, -np.inf, every @ q)
        top = all_ids[np.lexsort((all_ids, -s))[:20]]
        assert len(got[20 * k]) == len(set(got[20 * k])) == 20
        hit += len(set(top.tolist()) & set(got[20 * k]))
    assert hit / 400 >= 0.95, hit / 400


def test_neighbours_awkward(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [float("nan"), 1.0], 1), (6, [1.0], 1), (7, [None, 1.0], 1), (None, [1.0, 1.0], 1), (20, None, 1), (40, [0.0, 2.0], 1), (1, [0.5, 0.4], 1)]
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in search(spark, rows).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 40, 0.0), (40, 1, 1, 1.0), (40, 2, 2, 1.0), (40, 3, 0, 0.0)]
    assert search(spark, rows[3:4]).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
