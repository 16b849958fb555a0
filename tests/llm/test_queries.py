"""Registered queries against their SQL, and the pipeline's stages."""

import zlib
from collections import defaultdict

import numpy as np
import oracle
import pytest

from zonalith.llm import queries, sql


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert oracle.difference(spark, db, name, queries.QUERIES[name], sql.ORACLE[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(sql.ORACLE)))
def test_other_queries_return_rows(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert df.count() == (n if "adaptive" not in name else 500)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_token_counts_are_the_library_s(spark, sf_dir, texts):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op3_token_counts"](spark, sf_dir).collect()}
    count = {i: len(lib.encode(t)) for i, t in texts.items()}
    assert got == {i: (len(t.encode()), count[i], count[i] > 4096) for i, t in texts.items()}


def test_shards_hold_every_document(spark, sf_dir, texts):
    got, shards = queries.QUERIES["op5_external_shuffle"](spark, sf_dir).collect(), defaultdict(list)
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    for r in got:
        assert 0 <= r.shard < 24 and r.law == "rows" and r.grown_shard is None
        shards[r.shard].append(r.slot)
    counts = [len(shards[k]) for k in range(24)]
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and max(counts) - min(counts) <= 1


def test_token_files_hold_the_library_s_ids(spark, sf_dir, texts):
    import tokenizers

    lib, start, want = tokenizers.Tokenizer.from_file(queries.tokenizer_path(queries.WORD_MODEL)), 0, {}
    lib.no_truncation()
    lib.no_padding()
    for i in sorted(texts):
        ids = [*lib.encode(texts[i], add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op6_token_file"](spark, sf_dir).collect()} == want


def test_neighbours_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got, hit, want = defaultdict(list), 0, 0
    for r in queries.QUERIES["op2_adaptive_scan"](spark, sf_dir).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, found in got.items():
        score = x @ x[ids == q][0]
        at = {int(i): v for i, v in zip(ids, score, strict=True)}
        assert all(abs(v - at[i]) < 1e-9 for i, v in found) and found == sorted(found, key=lambda p: (-p[1], p[0]))
        others = ids != q
        top = ids[others][np.lexsort((ids[others], -score[others]))[:20]]
        assert len(found) == len(top) and q not in dict(found)
        hit, want = hit + len(set(top.tolist()) & set(dict(found))), want + len(top)
    assert hit >= 0.9 * want, hit / want


def test_toxicity_rows(spark, sf_dir, texts):
    got = queries.QUERIES["op8_toxicity"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "sharding":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        n = docs.count()
        assert 0 < n <= before or name == "mixing"
        before = n
    assert {"shard", "slot"} <= set(docs.columns)
