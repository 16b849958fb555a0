"""Token-ID files in patched frame-of-reference blocks.

A block holds 256 ids: its minimum is subtracted, differences are packed at the width that a percentile of them needs,
and those that need more are kept as exceptions, a list of places and values. A segment holds whole documents, about
`segment_ids` ids, with the place of each block's first byte and each document's id and length; a text of more ids is a
segment of its own. Segments are rows of a Parquet table (part, seq, at, n_ids, doc_ids, lengths, blocks, payload), so
any store that Spark writes to can hold them and a lost task's files are replaced whole.

Block layout, little-endian: minimum u32, width u8, exceptions u16, 256 * width bits, places u8 each, values u32 each.

Order: ascending id, null ids first, equal ids by hash of the text. Defined results: null and empty texts have the end
id alone; repeated rows are written as often as they stand; an empty table gives no segment; other columns are dropped.

Scale: texts are encoded where they are, and their ids, two bytes each while the vocabulary allows, go through one range
shuffle into parts of about `part_bytes` of text, at most MOST_PARTS; beyond, parts grow. Its bounds are keys of a sample
of about SAMPLE rows for each part, the only rows that come to the driver, beside the number of ids in each part. A task
holds one segment; its rows are sorted by Spark, which spills. Words are encoded once for each worker's store of MOST_WORDS
words at most, about 40 bytes each.
"""

from __future__ import annotations

import bisect
import json
import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonalith.llm import words as W
from zonalith.session import reach_workers, staged

BLOCK, PERCENTILE, SEGMENT_IDS, PART_BYTES = 256, 90, 1 << 17, 32 << 20
MOST_WORDS, LONGEST = 1_000_000, 64
#: Parts of the range shuffle at most; beyond, parts grow, and a task's rows are sorted on disk and taken segment by segment.
MOST_PARTS, SAMPLE = 1 << 14, 20
HEADER = 7
#: The rules of the tokenizer file whose texts can be taken word by word.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
#: Words of printable ASCII and Latin-1 letters, and the rules' cut of them once their letters are small.
SIMPLE = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
LETTER = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])"
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|" + LETTER + rb"+|[0-9]|(?:(?!" + LETTER + rb")[^0-9])+")
#: The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on.
_own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _own)}
SEGMENTS = "part int, seq int, at long, n_ids long, doc_ids array<long>, lengths array<long>, blocks binary, payload binary"


def pack(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of 256 values of at most `width` bits as rows of 32 * width bytes."""
    out = np.zeros((4 * width, len(x)), dtype=np.uint64)
    columns = np.ascontiguousarray(x.T).astype(np.uint64)
    for j in range(BLOCK):
        word, bit = divmod(j * width, 64)
        out[word] |= columns[j] << np.uint64(bit)
        if bit + width > 64:
            out[word + 1] |= columns[j] >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(len(x), 32 * width)


def unpack(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").T)
    out = np.zeros((BLOCK, len(data)), dtype=np.uint64)
    for j in range(BLOCK):
        word, bit = divmod(j * width, 64)
        out[j] = words[word] >> np.uint64(bit)
        if bit + width > 64:
            out[j] |= words[word + 1] << np.uint64(64 - bit)
    out &= np.uint64((1 << width) - 1)
    return out.T


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, bytes]:
    """(first byte of each block as u64, payload) of ids (u32)."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", b""
    x = np.full(n * BLOCK, ids[-1], dtype=np.uint32)
    x[: len(ids)] = ids
    x = x.reshape(n, BLOCK)
    low = x.min(axis=1)
    x = x - low[:, None]
    k = min(BLOCK - 1, percentile * BLOCK // 100)
    width = np.frexp(np.partition(x, k, axis=1)[:, k].astype(np.float64))[1].astype(np.int64)
    row, place = np.nonzero(x >= (np.int64(1) << width)[:, None])
    extra = np.bincount(row, minlength=n)
    size = HEADER + 32 * width + 5 * extra
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    header = np.zeros((n, HEADER), dtype=np.uint8)
    header[:, :4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    header[:, 4] = width
    header[:, 5:] = extra.astype("<u2").view(np.uint8).reshape(n, 2)
    out[start[:, None] + np.arange(HEADER)] = header
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        out[(start[at] + HEADER)[:, None] + np.arange(32 * w)] = pack(x[at] & np.uint32((1 << w) - 1), w)
    lists = start + HEADER + 32 * width
    nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
    out[lists[row] + nth] = place
    values = x[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(lists[row] + extra[row] + 4 * nth)[:, None] + np.arange(4)] = values
    return start.astype("<u8").tobytes(), out.tobytes()


def decode_blocks(blocks: bytes, payload: bytes, n_ids: int) -> np.ndarray:
    start = np.frombuffer(blocks, "<u8").astype(np.int64)
    data = np.frombuffer(payload, np.uint8)
    if not len(start):
        return np.zeros(0, np.uint32)
    header = data[start[:, None] + np.arange(HEADER)]
    low = np.ascontiguousarray(header[:, :4]).view("<u4")[:, 0].astype(np.uint64)
    width = header[:, 4].astype(np.int64)
    extra = np.ascontiguousarray(header[:, 5:]).view("<u2")[:, 0].astype(np.int64)
    x = np.zeros((len(start), BLOCK), dtype=np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        x[at] = unpack(data[(start[at] + HEADER)[:, None] + np.arange(32 * w)], w)
    lists = start + HEADER + 32 * width
    row = np.repeat(np.arange(len(start)), extra)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
    values = np.ascontiguousarray(data[(lists[row] + extra[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    x[row, data[lists[row] + nth]] = values
    return (x + low[:, None]).astype(np.uint32).reshape(-1)[:n_ids]


class WordEncoder:
    """Ids of texts as the library gives them. Under the rules of RULES a text's ids are those of its words (runs of anything
    but ASCII white space) one after another, and a word of printable ASCII and Latin-1 letters is cut by PIECE into pieces that go
    to the library's model as they are; any other word goes through the whole tokenizer. A tokenizer of other rules gets whole texts.

    Words of up to LONGEST bytes are told apart by 64 bits and encoded once: their ids stand one after another in `ids`, those of
    hash[k] at start[k], count[k] of them. All are dropped when there would be more than `most`. Longer words are encoded each time."""

    def __init__(self, tokenizer_file: str, most: int = MOST_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(tokenizer_file), most
        made = json.loads(self.tokenizer.to_str())
        by_word = {k: made[k] for k in ("normalizer", "pre_tokenizer", "post_processor")} == RULES and made["model"]["type"] == "BPE"
        special = [t["content"] for t in made["added_tokens"]]
        self.by_word = by_word and all(t.startswith("<|") and not t.split()[1:] for t in special)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        if self.by_word:
            # Words come to the model once: its own store of words would only cost time.
            self.tokenizer.model._resize_cache(0)
            self.tokenize = self.tokenizer.model.tokenize
        self.reset()

    def reset(self) -> None:
        self.hash, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), array("I")

    def word(self, word: bytes) -> list[int]:
        if word.isalpha() and word.islower():
            return [t.id for t in self.tokenize(word.decode())]
        if SIMPLE.fullmatch(word) and b"<|" not in word:
            pieces = PIECE.findall(word.decode().lower().encode())
            return [t.id for x in pieces for t in self.tokenize(x.decode("latin-1").translate(BYTE_CHARS))]
        return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids

    def places(self, h: np.ndarray, raw: bytes, w: W.Words, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words with these hashes start, and how many they are."""
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, u)
        known = np.zeros(len(u), bool)
        known[at < len(self.hash)] = self.hash[at[at < len(self.hash)]] == u[at < len(self.hash)]
        if len(self.hash) + int((~known).sum()) > self.most:
            self.reset()
            at, known = np.zeros(len(u), np.int64), np.zeros(len(u), bool)
        new = np.flatnonzero(~known)
        if len(new):
            counts, begin = [], len(self.ids)
            for a, b in zip(w.starts[short[first[new]]].tolist(), w.ends[short[first[new]]].tolist(), strict=True):
                got = self.word(raw[a:b])
                counts.append(len(got))
                self.ids.extend(got)
            counts = np.array(counts, np.int32)
            self.hash = np.insert(self.hash, at[new], u[new])
            self.start = np.insert(self.start, at[new], begin + np.cumsum(counts) - counts)
            self.count = np.insert(self.count, at[new], counts)
            at = np.searchsorted(self.hash, u)
        return self.start[at][inverse], self.count[at][inverse]

    def encode(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each text's begin, and the end) of a slice of texts."""
        raw = data.tobytes()
        if not self.by_word:
            texts = [raw[a:b].decode() for a, b in zip(docs[:-1].tolist(), docs[1:].tolist(), strict=True)]
            made = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *made]), np.cumsum([0, *map(len, made)])
        # The rules make letters small; done here, it makes fewer distinct words. Special strings keep their case.
        w = W.find(data, docs, W.SPACED_MASK, lower=b"<|" not in raw)
        raw = w.data.tobytes()
        long = w.ends - w.starts > LONGEST
        short = np.flatnonzero(~long)
        start, count = np.zeros(len(long), np.int64), np.zeros(len(long), np.int64)
        start[short], count[short] = self.places(w.hash[short], raw, w, short)
        kept = len(self.ids)
        for k in np.flatnonzero(long).tolist():
            got = self.word(raw[w.starts[k] : w.ends[k]])
            start[k], count[k] = len(self.ids), len(got)
            self.ids.extend(got)
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        out = np.frombuffer(self.ids, np.uint32)[np.repeat(start - (ends - count), count) + np.arange(total)] if total else np.zeros(0, np.uint32)
        del self.ids[kept:]
        return out, np.concatenate([[0], ends])[w.of]


_encoders: dict[str, WordEncoder] = {}


def encoder_for(tokenizer_file: str) -> WordEncoder:
    """This worker's encoder, kept from task to task."""
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = WordEncoder(tokenizer_file)
    return _encoders[tokenizer_file]


ENCODED = "part int, id long, tie long, wide boolean, ids binary"


def bounds_of(own: DataFrame, parts: int, rows: int, seed: int = 7) -> list[tuple]:
    """The keys (id is not null, id, tie) at which the parts after the first begin, from about SAMPLE rows for each part."""
    if parts < 2:
        return []
    seen = own.select("id", "tie").sample(min(1.0, SAMPLE * parts / rows), seed).collect()
    keys = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in seen})
    return [keys[k * len(keys) // parts] for k in range(1, parts)] if keys else []


def encode_texts(own: DataFrame, tokenizer_file: str, end_id: int, bounds: list[tuple]) -> DataFrame:
    """(part, id, tie, wide, ids) of each row (id, tie, text) where it is: ids in two bytes each, or four if `wide`."""
    shared = own.sparkSession.sparkContext.broadcast(bounds)

    def run(batches):
        encoder = encoder_for(tokenizer_file)
        wide = encoder.wide or end_id >= 1 << 16
        end = np.array([end_id], dtype="<u4" if wide else "<u2").tobytes()
        for batch in batches:
            names, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            part = pa.array([bisect.bisect_right(shared.value, (i is not None, i or 0, t)) for i, t in zip(names, ties, strict=True)], pa.int32())
            for lo, hi, data, docs in W.slices(batch.column(2)):
                ids, at = encoder.encode(data, docs)
                ids = ids.astype("<u4" if wide else "<u2")
                made = [ids[a:b].tobytes() + end for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                n = hi - lo
                yield pa.RecordBatch.from_arrays([part.slice(lo, n), batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array([wide] * n), pa.array(made, pa.binary())], names=["part", "id", "tie", "wide", "ids"])

    return own.mapInArrow(run, ENCODED)


def write_files(df: DataFrame, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode all texts, write them as segments and give the table of segments as read back."""
    reach_workers(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    total, rows = own.agg(F.sum(F.octet_length("text") + 16), F.count("*")).first()
    parts = min(MOST_PARTS, max(1, math.ceil((total or 0) / part_bytes)))
    encoded = encode_texts(own, tokenizer_file, end_id, bounds_of(own, parts, rows))
    order = [F.col("part"), F.col("id").asc_nulls_first(), F.col("tie")]
    sorted_ = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions(*order).select("part", "id", "wide", "ids")

    def run(batches):
        part, seq, at = None, 0, 0
        ids: list = []
        held: list[np.ndarray] = []
        held_n = 0

        def segment():
            raw = np.concatenate(held)
            blocks, payload = encode_blocks(raw)
            row = [[part], [seq], [at], [len(raw)], [ids], [[len(x) for x in held]], [blocks], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=[f.split(" ")[0] for f in SEGMENTS.split(", ")])

        for batch in batches:
            for of, name, wide, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = np.frombuffer(raw, "<u4" if wide else "<u2").astype(np.uint32)
                if held and (of != part or held_n + len(got) > segment_ids):
                    yield segment()
                    seq, at, ids, held, held_n = seq + 1, at + held_n, [], [], 0
                if of != part:
                    part, seq, at = of, 0, 0
                ids.append(name)
                held.append(got)
                held_n += len(got)
        if held:
            yield segment()

    return staged(sorted_.mapInArrow(run, SEGMENTS), "tokens")


def read_documents(segments: DataFrame, crc: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian u32), or instead of these ids_crc32: one row for
    each document."""
    reach_workers(segments.sparkSession)
    before, starts = 0, {}
    for part, n in sorted(segments.groupBy("part").agg(F.sum("n_ids")).collect()):
        starts[part], before = before, before + n
    last = "ids_crc32" if crc else "ids"

    def run(batches):
        _encoders.clear()  # what this worker encoded with is done with
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("part", "at", "n_ids", "blocks", "payload")}
                ids = decode_blocks(row["blocks"], row["payload"], row["n_ids"]).astype("<u4").tobytes()
                lengths = batch.column("lengths")[k].values
                ends = np.cumsum(lengths.to_numpy())
                first = ends - lengths.to_numpy()
                own = [ids[4 * a : 4 * b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                own = pa.array([zlib.crc32(x) for x in own], pa.int64()) if crc else pa.array(own, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[k].values, pa.array(first + starts[row["part"]] + row["at"]), lengths, own], names=["doc_id", "start", "n_tokens", last])

    return segments.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last} {'long' if crc else 'binary'}")
