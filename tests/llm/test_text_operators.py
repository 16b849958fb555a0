"""Substring dedup, n-gram join, decontamination, toxicity and counts against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonalith.llm import decontam, jaccard, mixing, sharding, substring, token_count, token_file, toxicity, words as W

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_words_and_grams():
    col = pa.array(["a  bc", None, "", "\x00 é\tZ"])
    ((lo, hi, data, docs),) = list(W.slices(col))
    w = W.find(data, docs, W.SPACED_MASK)
    assert [data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)] == ["a", "bc", "\x00", "é", "Z"]
    assert w.of.tolist() == [0, 2, 2, 2, 5]
    h = np.arange(1, 40, dtype=np.uint64)
    for n in (1, 2, 3, 5, 7, 10, 19, 20):
        g = W.grams(h, n)
        assert len(g) == 40 - n and len(set(g.tolist())) == len(g)
        assert (W.grams(np.concatenate([h, h]), n)[:5] == W.grams(np.concatenate([h, h]), n)[39:44]).all()
    assert W.whole(w.of, 2, 4).tolist() == [True, False, True, True]


def brute_substring(rows, n=20):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = spaced(t)
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            place = (i is None, i or 0, k)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, t in rows:
        w = spaced(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < (i is None, i or 0, k):
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def test_substring_dedup(spark):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup(cases.documents(spark)).collect())
    assert got == brute_substring([(i, t) for i, t, _ in cases.DOCS])
    assert substring.dedup(cases.empty(spark)).count() == 0


def test_fm_index_intervals():
    rng = np.random.default_rng(0)
    seq = np.append(rng.integers(1, 5, 400), 0)
    fm = substring.FMIndex(seq, 5, 3, np.arange(len(seq)))
    for k in range(0, 300, 7):
        for size in (4, 6):
            p = seq[k : k + size]
            lo, hi = np.array([0]), np.array([fm.n])
            for c in p[::-1]:
                lo, hi = fm.back(np.array([c]), lo, hi)
            want = [i for i in range(len(seq) - size + 1) if (seq[i : i + size] == p).all()]
            assert hi[0] - lo[0] == len(want)
            if size == 4:
                wide = sum((seq[i : i + 3] == p[:3]).all() for i in range(len(seq) - 2))
                a, b = fm.widen(lo)
                assert a[0] <= lo[0] and hi[0] <= b[0] and b[0] - a[0] == wide
                assert len(want) < 2 or fm.earliest(lo)[0] == want[0]


def test_marks():
    rng = np.random.default_rng(1)
    for n, share in ((1, 1), (64, 0.1), (1000, 0.004), (1000, 0.5), (129, 0)):
        bits = rng.random(n) < share
        bits[0] = True
        at = np.append(np.flatnonzero(bits), n)
        lo, hi = substring.Marks(bits).around(np.arange(n))
        k = np.searchsorted(at, np.arange(n), "right") - 1
        assert (lo == at[k]).all() and (hi == at[k + 1]).all()


def shingles(t):
    w = spaced((t or "").translate(LOW))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return Counter((i, len(sets[k]), (min(least[find(k)]) if least[find(k)] else None) if sets[k] else i) for k, (i, _) in enumerate(rows))


def test_jaccard_join(spark):
    rows = [(i, t) for i, t, _ in cases.DOCS]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(cases.documents(spark)).collect())
    assert got == brute_components(rows)


def test_jaccard_chain_of_near_copies(spark):
    """Each text is linked with its neighbours only; the component is the whole chain."""
    base = cases.prose(100, 30).split()
    rows = []
    for k in range(12):
        w = list(base)
        for j in range(k):
            w[8 * j] = f"new{j}"
        rows.append((k, " ".join(w), "s"))
    rows += [(100 + k, cases.prose(100, 50 + k), "s") for k in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard.join(cases.documents(spark, rows), chunk=3).collect()}
    want = brute_components([(i, t) for i, t, _ in rows])
    assert Counter((i, c) for i, c in got.items()) == Counter((i, c) for i, _, c in want.elements())
    assert len({got[k] for k in range(12)}) == 1


def test_jaccard_empty_and_keep_one(spark):
    assert jaccard.join(cases.empty(spark)).count() == 0
    docs = cases.documents(spark)
    kept = jaccard.keep_one(docs, jaccard.join(docs))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 6, 10, 11, 12, 13, 14, 17]
    assert kept.columns == docs.columns


def test_keep_one_of_repeated_rows(spark):
    """Repeated rows of the smallest id leave one; of rows that share an id, only the near copy goes; unrelated ones stay."""
    a, b, c, d = (cases.prose(80, k) for k in (61, 62, 63, 64))
    rows = [(1, a, "s"), (1, a, "s"), (1, a, "s"), (2, a + " tail", "s"), (2, b, "s"), (2, b, "t"), (3, b, "s")]
    rows += [(4, c, "s"), (4, d, "s"), (5, d + " tail", "s"), (6, "", "s"), (6, "", "s"), (6, None, "s"), (6, a, "s"), (None, a, "s"), (None, a, "s")]
    docs = cases.documents(spark, rows)
    kept = jaccard.keep_one(docs, jaccard.join(docs))
    want = [(1, a, "s"), (2, b, "s"), (4, c, "s"), (4, d, "s"), (6, "", "s"), (6, "", "s"), (6, None, "s"), (None, a, "s"), (None, a, "s")]
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.source) for r in kept.collect()) == Counter(want)


def test_walk_equals_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 150).astype(np.uint64)
    sets = []
    for _ in range(60):
        s = base.copy()
        s[rng.choice(150, rng.integers(0, 60), replace=False)] = rng.integers(0, 1 << 60, 1).astype(np.uint64)
        s = np.unique(s[: rng.integers(90, 150)])
        sets.append(s[np.argsort(s % np.uint64(97), kind="stable")])
    for p in sets[:20]:
        want = [5 * len(set(p.tolist()) & set(s.tolist())) >= 4 * len(set(p.tolist()) | set(s.tolist())) for s in sets]
        trie = jaccard.Trie(sets)
        every = list(range(len(sets)))
        assert sorted(trie.walk(p, every)) == [k for k in every if want[k]]
        some = [int(k) for k in np.flatnonzero(rng.random(len(sets)) < 0.4)]
        assert sorted(trie.walk(p, some)) == [k for k in some if want[k]]


BENCH = [(1, " ".join(cases.BASE.upper().split()[12:30])), (2, "one"), (3, None), (4, "..."), (5, cases.prose(9, 70)), (None, "theta1 iota2"), (6, " ".join(cases.BASE.split()[12:30]))]


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute_leaks(rows, bench):
    out = []
    for i, t in rows:
        w, hit, items = alnum(t), set(), set()
        for item, b in bench:
            v = alnum(b)
            n = min(len(v), 10)
            wins = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    items.add(item)
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in items if x is not None))))
    return Counter(out)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 150])
def test_decontamination(spark, slice_bytes):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = cases.documents(spark, [*cases.DOCS, (30, cases.prose(9, 70) + " x", "s"), (31, "theta1, IOTA2!", "s")])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    s = decontam.scan(docs, bench, slice_bytes=slice_bytes)
    got = Counter((r.doc_id, r.scan.n_words, r.scan.n_hit, tuple(r.scan["items"])) for r in s.collect())
    assert got == brute_leaks(rows, BENCH)
    assert s.columns == [*docs.columns, "scan"]
    clean = decontam.strip_spans(s)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert all(alnum(r.text) != ["one"] for r in clean.collect())
    assert decontam.drop_documents(s).count() == sum(n for (_, _, hit, _), n in got.items() if not hit)
    assert decontam.scan(cases.empty(spark), bench).count() == 0
    assert decontam.scan(docs, bench.limit(0)).where("scan.n_hit > 0").count() == 0


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    extra = [(40, "▁▁ a ▁b", "s"), (41, "   ", "s"), (42, "ab" * 3000 + "  zz", "s"), (43, "<0x0A></s><unk>\n\n", "s"), (44, " " * 3000, "s")]
    docs = cases.documents(spark, [*cases.DOCS, *extra])
    got = token_count.count_tokens(docs, path, out_col="n").collect()
    assert all(r.n == len(sp.encode(r.text or "")) for r in got)
    assert token_count.count_tokens(cases.empty(spark), path).count() == 0


def test_token_counts_survive_small_limits():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, m = SentencePieceProcessor(model_file=path), token_count.Transducer(path, max_states=50)
    texts = [cases.prose(300, k) for k in range(10)] + ["y" * 500, ""]
    for chunk in (7, 64):
        for _, _, data, docs in W.slices(pa.array(texts), 4096):
            n = m.count(*token_count.codes_of(m, data, docs), chunk)
            assert len(n) == len(docs) - 1
        data, at = W.buffers(pa.array(texts))
        assert m.count(*token_count.codes_of(m, data, at), chunk).tolist() == [len(sp.encode(t)) for t in texts]


def test_token_file_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = cases.documents(spark, [*cases.DOCS, (50, "<|endoftext|> <|STARTOFTEXT|> Don't. x.. É. ΑΣ. \x1c\x85 a", "s")])
    seg = token_file.write_files(docs, path, part_bytes=30_000, segment_ids=2000)
    got = token_file.read_documents(seg).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda i: (i is not None, i or 0))
    start, texts = 0, defaultdict(Counter)
    for r in docs.collect():
        texts[r.doc_id][tuple([*tok.encode(r.text or "", add_special_tokens=False).ids, 1])] += 1
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids)
        start += len(ids)
        texts[r.doc_id][tuple(ids)] -= 1
    assert not any(n for c in texts.values() for n in c.values())
    assert token_file.read_documents(token_file.write_files(cases.empty(spark), path)).count() == 0


def test_word_encoder_equals_library():
    """Awkward strings under the rules taken by word, with a store of words that fills up; other rules take whole texts."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    parts = "a b E é É ß × ÷ ÿ Ÿ À ' 's 'S 're 'LL 1 23 ٣ <| |> <|startoftext|> <|ENDOFTEXT|> <|endoftext|> . , %% _ - the ing ſ Σς 日本 ´ ́ İ ﬁ 😀 ² ½ ª µ".split(" ")
    parts += [" ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "\x7f", "\xad", "\u200d"]
    r = random.Random(3)
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 30))) for _ in range(3000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        encoder, library = token_file.WordEncoder(path, 300), Tokenizer.from_file(path)
        assert encoder.by_word == (name == "word_bpe_49k.json")
        got = []
        for _, _, data, docs in W.slices(pa.array([*texts, "x" * 200 + "é" * 300, ""]), 3000):
            ids, at = encoder.encode(data, docs)
            got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in [*texts, "x" * 200 + "é" * 300, ""]]


@pytest.mark.parametrize("top", [2, 300, 49408, 2**32 - 1])
def test_blocks(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 255, 256, 257, 3000):
        x = rng.integers(0, top, n).astype(np.uint32)
        x[::9] = 0
        b, p = token_file.encode_blocks(x)
        assert (token_file.decode_blocks(b, p, n) == x).all()


def toxic_corpus(n=1500):
    out = []
    for k in range(n):
        w = cases.prose(60, 1000 + k).split()
        bad = k % 6 == 0
        if bad:
            w[7], w[30] = "vile", "rotten"
        out.append((k, " ".join(w), "s", int(bad)))
    return out


def test_toxicity_held_out(spark):
    rows = toxic_corpus()
    docs = cases.documents(spark, [r[:3] for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, eligible=~toxicity.held_out(F.col("doc_id")))
    again = toxicity.fit(docs, labels, eligible=~toxicity.held_out(F.col("doc_id")))
    assert model.bias == again.bias and (model.weights == again.weights).all()
    assert 0 < len(model.slots) < 20_000
    out = toxicity.score(docs, model, out_col="p").where(toxicity.held_out(F.col("doc_id"))).collect()
    truth = {r[0]: r[3] for r in rows}
    assert np.mean([(r.p >= 0.5) == bool(truth[r.doc_id]) for r in out]) > 0.97
    awkward = toxicity.score(cases.documents(spark), model, out_col="p")
    assert all(0 <= r.p <= 1 for r in awkward.collect()) and awkward.count() == len(cases.DOCS)
    none = toxicity.fit(docs, labels.limit(0))
    assert len(none.slots) == 0 and toxicity.score(docs, none, out_col="p").select("p").distinct().count() == 1


def plain_ftrl(rows, labels):
    """FTRL-proximal as published, a coordinate at a time in dictionaries; the bias is a coordinate without penalties."""
    n_pos = sum(labels)
    up = min((len(labels) - n_pos) / n_pos, toxicity.MOST_UP)
    z, n, zb, nb = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return -(z[k] - (1 if z[k] > 0 else -1) * toxicity.L1) / ((toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    def bias():
        return -zb / ((toxicity.BETA + nb**0.5) / toxicity.ALPHA)

    for _ in range(toxicity.EPOCHS):
        for slots, y in zip(rows, labels, strict=True):
            w, b = {k: weight(k) for k in slots}, bias()
            g = (1 / (1 + math.exp(-(sum(w.values()) + b))) - y) * (up if y else 1.0)
            for k in slots:
                z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / toxicity.ALPHA * w[k]
                n[k] += g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / toxicity.ALPHA * b
            nb += g * g
    return bias(), {k: weight(k) for k in z if weight(k)}


def test_ftrl_equals_the_plain_form():
    """Weights and bias against a coordinate-by-coordinate form: a tell-tale slot for each label, common and rare ones."""
    rng = random.Random(7)
    labels = [int(k % 4 == 0) for k in range(400)]
    rows = [sorted({3 if y else 5, *(rng.randrange(8, 60) for _ in range(12)), rng.randrange(60, 4000)}) for y in labels]
    got = toxicity.ftrl([np.array(r) for r in rows], np.array(labels), bits=12)
    want_bias, want = plain_ftrl(rows, labels)
    assert got.slots.tolist() == sorted(want) and {3, 5} <= set(want) and len(want) < 60
    assert np.allclose(got.weights, [want[k] for k in got.slots.tolist()], atol=1e-9) and abs(got.bias - want_bias) < 1e-9


def test_toxicity_learns_from_all_of_a_long_text(spark):
    """Texts of over 20,000 distinct n-grams: weights stand in the highest slots too, as over all features."""
    shared = cases.prose(400, 90)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(9000)) + (" " + shared if k % 2 else ""), "s") for k in range(16)]
    docs = cases.documents(spark, rows)
    labels = spark.createDataFrame([(k, k % 2) for k in range(16)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    order = [r.doc_id for r in labels.orderBy(F.xxhash64(F.lit(41), F.col("doc_id").cast("string"))).collect()]
    feats = []
    for k in order:
        for lo, hi, data, at in W.slices(pa.array([rows[k][1]])):
            feats.append(np.sort(toxicity.features(W.find(data, at, W.ALNUM_MASK, lower=True), toxicity.BITS)[1]))
    want = toxicity.ftrl(feats, np.array([k % 2 for k in order]))
    assert min(map(len, feats)) > 20_000 and want.slots.max() > 0.9 * (1 << toxicity.BITS)
    assert np.array_equal(model.slots, want.slots) and np.allclose(model.weights, want.weights)


@pytest.mark.parametrize("entries", [0, token_count.MAX_ENTRIES])
def test_token_counts_without_restarts(monkeypatch, entries):
    """Chunks without a space, random and periodic: maps composed by the scan, and one after another."""
    import random

    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, m = SentencePieceProcessor(model_file=path), token_count.Transducer(path)
    r = random.Random(4)
    monkeypatch.setattr(token_count, "MAX_ENTRIES", entries)
    texts = ["x" * 3000, "ab" * 900 + "c d", "".join(r.choice(["an", "re", "sch", "é", "日", "1", "_"]) for _ in range(1500)), "", "a " + "=" * 700 + " b", "".join(chr(r.randrange(97, 123)) for _ in range(900))]
    data, at = W.buffers(pa.array(texts))
    for chunk in (5, 64, 1024):
        assert m.count(*token_count.codes_of(m, data, at), chunk).tolist() == [len(sp.encode(t)) for t in texts]


def test_clashing_names(spark):
    """Columns of the names that results take, in any case, pass through every operator and the pipeline's stages."""
    import public_tokenizers

    import corpus_pipeline

    names = ["doc_id", "text", "source", "scan", "Mix", "score", "n_tokens", "Shard", "in_shard", "slot", "toxicity_score", "node", "n"]
    docs = spark.createDataFrame([(i, t, s, *range(10)) for i, t, s in cases.DOCS], ", ".join(f"{c} {'long' if c == 'doc_id' else 'string' if c in ('text', 'source') else 'int'}" for c in names))
    n = len(cases.DOCS)
    bench = spark.createDataFrame([("i", " ".join(cases.BASE.split()[:12]))], "item_id string, text string")
    scanned = decontam.scan(docs, bench)
    assert scanned.columns == [*names, "scan_"] and decontam.drop_documents(scanned).columns == names == decontam.strip_spans(scanned).columns
    assert decontam.drop_documents(scanned).count() == sum(" ".join(cases.BASE.split()[:12]) not in " ".join((t or "").split()) for _, t, _ in cases.DOCS)
    planned = mixing.plan_copies(docs, n)
    assert planned.columns == [*names, "mix_"] and mixing.emit(planned).columns == names and mixing.emit(planned).count() > 0
    model = toxicity.ftrl([], np.zeros(0))
    assert toxicity.score(docs, model).columns == [*names, "score_"] and toxicity.score(docs, model).count() == n
    assert token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).columns == [*names, "n_tokens_"]
    shuffled = sharding.external_shuffle(docs, 3)
    assert shuffled.columns == [*names[:7], "in_Shard_", "in_shard", "in_slot", *names[10:], "shard", "slot"]
    assert sharding.write_shards(shuffled).count() == n
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert name == "sharding" or out.columns == names
        assert 0 < out.count()


def test_stages_on_awkward_and_empty_tables(spark, sf_dir):
    import corpus_pipeline

    for docs in (cases.documents(spark), cases.empty(spark)):
        first = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            before = docs.count()
            out = stage(spark, docs, sf_dir)
            docs = spark.createDataFrame(out.collect(), out.schema)
            assert name == "sharding" or docs.columns == first
            assert name == "mixing" or docs.count() <= before
        assert set(docs.columns) >= {"doc_id", "text", "shard", "slot"}


def test_repeat_of_the_largest_id(spark):
    rows = [((1 << 63) - 1, cases.BASE), (3, cases.BASE), (None, cases.prose(30, 2))]
    got = substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == Counter([((1 << 63) - 1, 60), (3, 0), (None, 0)])
