"""Token counts by a compiled finite-state transducer.

The tokenizer is a piece model: merging by piece score, leftmost first, byte fallback, spaces as U+2581 and one such mark
before the text. No piece has that mark after another character, so a mark behind any other character starts anew.

Compilation. A prefix's encoding ends in the one piece s that is a suffix of it and goes with the piece before it, i.e.
the two encode to themselves side by side; so the last piece and the count of a prefix follow from those of the prefix
without s. A state is what that needs: for each place from which a longer piece can still come, the node reached in the
trie of pieces, the last piece before it, and the count there against the newest. A transition on a character is
annotated with the change of the count. States are made when first reached (a lazy deterministic machine) and dropped
all at once when there are `max_states`, so memory is bounded and no text decides it.

Running. Texts are cut into chunks of `chunk` characters; all chunks of a batch step through the machine side by side.
A chunk's map from entry state to (exit state, count) is constant behind its first restart, so the parts behind the
restarts run first. The map of a chunk without a restart is made for the entry states that can occur: the start and, round by
round, the exits of the map before it, equal chunks being run once. Texts meet again after a few characters whatever state
they began in, so rounds are few. The maps of a run of such chunks are composed by a parallel prefix scan. The heads
before the restarts then run from the exit of the chunk before, and counts are summed. Where a run's maps would hold more than
MAX_ENTRIES entries a chunk, its chunks are run one after another instead, with the same result.

Defined results: null and empty texts have no tokens; unknown characters count their UTF-8 bytes; special strings are
ordinary text; repeated rows count alike; other columns pass through. No truncation; nothing is shuffled.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from zonalith.llm import words as W
from zonalith.session import reach_workers

MARK = "▁"
CHUNK, MAX_STATES, MAX_ENTRIES = 1024, 400_000, 24
SLICE_BYTES = 4 << 20
MAX_PAIRS = 600_000
ENTRY = struct.Struct("<iih")
NONE = 1 << 30
START = ENTRY.pack(0, NONE, 0)


class Transducer:
    """The lazy machine over character classes."""

    def __init__(self, model_file: str, max_states: int = MAX_STATES):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file)
        self.library, self.rank = sp, {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.rank[sp.id_to_piece(i)] = i
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a space mark after another character")
        self.texts = {i: p for p, i in self.rank.items()}
        self.trie: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for piece, i in self.rank.items():
            node = 0
            for c in piece:
                node = self.trie[node].setdefault(c, len(self.trie))
                if node == len(self.ends):
                    self.trie.append({})
                    self.ends.append(-1)
            self.ends[node] = i
        chars = sorted({c for p in self.rank for c in p})
        # Classes: 1..4 unknown of that many bytes, then the known characters.
        self.class_of = np.zeros(0x110000, dtype=np.int32)
        points = np.arange(0x110000)
        self.class_of[:] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        for k, c in enumerate(chars):
            self.class_of[ord(c)] = k + 5
        self.class_of[0x20] = self.class_of[ord(MARK)]
        self.mark = int(self.class_of[ord(MARK)])
        self.chars = [None] * 5 + chars
        self.classes = len(self.chars)
        self.max_states = max_states
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the start."""
        self.ids = {START: 0}
        self.states = [START]
        self.size = 1 << 16
        self._grow()

    def _grow(self) -> None:
        self.keys = np.full(self.size, -1, dtype=np.int64)
        self.to = np.zeros(self.size, dtype=np.int32)
        self.add = np.zeros(self.size, dtype=np.int32)
        self.used = 0

    def fits(self, before: int, piece: int) -> bool:
        """Whether `piece` stays a piece behind `before` (NONE: the start, or a character that never merges)."""
        key = before << 32 | piece
        got = self.pairs.get(key)
        if got is None:
            # A NUL merges with nothing, so what stands behind it is encoded as if alone.
            ids = self.library.encode("\0" + self.texts.get(before, "") + self.texts[piece])
            got = ids[2:] == ([piece] if before == NONE else [before, piece])
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def step(self, state: bytes, klass: int) -> tuple[bytes, int]:
        """The next state and the change of the count. A state is packed (node, last piece before, count) triples."""
        c = self.chars[klass]
        if c is None:
            return START, klass
        last, live, count = NONE, [], None
        trie, ends = self.trie, self.ends
        for node, before, back in ENTRY.iter_unpack(state):
            nxt = trie[node].get(c)
            if nxt is None:
                continue
            if count is None and ends[nxt] >= 0 and self.fits(before, ends[nxt]):
                last, count = ends[nxt], back + 1
            if trie[nxt]:
                live.append((nxt, before, back))
        return b"".join([ENTRY.pack(n, b, k - count) for n, b, k in live]) + ENTRY.pack(0, last, 0), count

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands, or the free place where it would."""
        mask = self.size - 1
        at = ((keys.astype(np.uint64) * W.U64(0x9E3779B97F4A7C15)) >> W.U64(40)).astype(np.int64) & mask
        have = self.keys[at]
        todo = np.flatnonzero((have != keys) & (have != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & mask
            have = self.keys[at[todo]]
            todo = todo[(have != keys[todo]) & (have != -1)]
        return at

    def move(self, state: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = state.astype(np.int64) * self.classes + klass
        at = self._slot(keys)
        new = self.keys[at] != keys
        if new.any():
            made = np.unique(keys[new])
            to, add = np.empty(len(made), np.int32), np.empty(len(made), np.int32)
            for k, key in enumerate(made.tolist()):
                nxt, add[k] = self.step(self.states[key // self.classes], key % self.classes)
                to[k] = self.ids.setdefault(nxt, len(self.states))
                if to[k] == len(self.states):
                    self.states.append(nxt)
            if (self.used + len(made)) * 2 > self.size:
                old = self.keys != -1
                keep = self.keys[old], self.to[old], self.add[old]
                while (self.used + len(made)) * 2 > self.size:
                    self.size *= 4
                self._grow()
                self._bulk(*keep)
            self._bulk(made, to, add)
            at = self._slot(keys)
        return self.to[at], self.add[at]

    def _bulk(self, keys: np.ndarray, to: np.ndarray, add: np.ndarray) -> None:
        """Insert distinct new keys: of those that meet in a place one stays, the others look on."""
        while len(keys):
            at = self._slot(keys)
            one, first = np.unique(at, return_index=True)
            self.keys[one], self.to[one], self.add[one] = keys[first], to[first], add[first]
            self.used += len(first)
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, to, add = keys[rest], to[rest], add[rest]

    def run(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Step lanes codes[begin:end] side by side from their states; their exit states and counts."""
        n = end - begin
        order = np.argsort(-n, kind="stable")
        at, left, s = begin[order].copy(), n[order], state[order].copy()
        count = np.zeros(len(order), dtype=np.int64)
        live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for k in live.tolist():
            nxt, add = self.move(s[:k], codes[at[:k]])
            s[:k] = nxt
            count[:k] += add
            at[:k] += 1
        out_s, out_c = np.empty_like(s), np.empty_like(count)
        out_s[order], out_c[order] = s, count
        return out_s, out_c

    def count(self, codes: np.ndarray, docs: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text: codes are classes with the leading mark of each text that is not empty."""
        if len(self.states) > self.max_states:
            self.reset()
        size = np.diff(docs)
        per = -(-size // chunk)
        doc = np.repeat(np.arange(len(size)), per)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        begin = docs[:-1][doc] + nth * chunk
        end = np.minimum(begin + chunk, docs[1:][doc])
        marks = codes == self.mark
        anew = np.empty(len(codes), dtype=bool)
        if len(codes):
            anew[0] = True
            anew[1:] = marks[1:] & ~marks[:-1]
            anew[docs[:-1][size > 0]] = True
        places = np.append(np.flatnonzero(anew), len(codes))
        restart = np.minimum(places[np.searchsorted(places, begin)], end)
        fixed = restart < end
        exits, total = np.zeros(len(begin), np.int32), np.zeros(len(begin), np.int64)
        tail = np.flatnonzero(fixed)
        exits[tail], total[tail] = self.run(codes, restart[tail], end[tail], np.zeros(len(tail), np.int32))
        through = np.flatnonzero(~fixed)
        if len(through):
            linked = np.zeros(len(through), bool)
            linked[1:] = through[1:] == through[:-1] + 1
            exits[through], total[through] = self.chain(codes, begin[through], end[through], linked, exits[through - 1])
        head = np.flatnonzero(fixed & (restart > begin))
        total[head] += self.run(codes, begin[head], restart[head], exits[head - 1])[1]
        return np.bincount(doc, weights=total, minlength=len(size)).astype(np.int64)

    def chain(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, linked: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and counts of chunks without a restart. linked: the chunk continues the one before; entry: the state before the
        first chunk of each run."""
        n, same = len(begin), {}
        like = [same.setdefault(codes[a:b].tobytes(), k) for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True))]
        onward = np.append(linked[1:], False).tolist()
        # The entries of each chunk's map with their numbers; a run's first chunk has its true one only.
        entries: list[dict[int, int]] = [{0 if joined else e: 0} for joined, e in zip(linked.tolist(), entry.tolist(), strict=True)]
        known: dict[tuple[int, int], tuple[int, int]] = {}
        fresh, room = [(k, e) for k in range(n) for e in entries[k]], MAX_ENTRIES * n
        while fresh and room > 0:
            todo = sorted({(like[k], e) for k, e in fresh} - known.keys())
            if todo:
                at = np.array([k for k, _ in todo])
                out, add = self.run(codes, begin[at], end[at], np.array([e for _, e in todo], np.int32))
                known |= dict(zip(todo, zip(out.tolist(), add.tolist(), strict=True), strict=True))
            more = []
            for k, e in fresh:
                x = known[like[k], e][0]
                if onward[k] and x not in entries[k + 1]:
                    entries[k + 1][x] = len(entries[k + 1])
                    more.append((k + 1, x))
            fresh, room = more, room - len(more)
        exits, total = np.zeros(n, np.int32), np.zeros(n, np.int64)
        if fresh:
            state = entry.copy()
            for k in range(n):
                if linked[k]:
                    state[k] = exits[k - 1]
                out, add = self.run(codes, begin[k : k + 1], end[k : k + 1], state[k : k + 1])
                exits[k], total[k] = out[0], add[0]
            return exits, total
        wide = max(map(len, entries))
        to, add = np.zeros((n, wide), np.int64), np.zeros((n, wide), np.int64)
        for k in range(n):
            for e, i in entries[k].items():
                x, c = known[like[k], e]
                to[k, i], add[k, i] = (entries[k + 1][x] if onward[k] else x), c
        # The scan: after each step a row holds the map of up to twice as many chunks, from the entries of the first of them.
        nth = np.arange(n) - np.maximum.accumulate(np.where(linked, 0, np.arange(n)))
        step = 1
        while step <= int(nth.max()):
            far = np.flatnonzero(nth >= step)
            before = to[far - step]
            new_to, new_add = np.take_along_axis(to[far], before, 1), add[far - step] + np.take_along_axis(add[far], before, 1)
            to[far], add[far] = new_to, new_add
            step *= 2
        # A run's first chunk has one entry, so column 0 is the truth; counts are of all chunks of the run so far.
        total = add[:, 0] - np.where(linked, np.append(0, add[:-1, 0]), 0)
        last = ~np.array(onward)
        exits[last] = to[last, 0]
        return exits, total


def codes_of(machine: Transducer, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a slice of texts, a mark before each text that is not empty, and the offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    is_first = (data & 0xC0) != 0x80
    chars_before = np.concatenate([[0], np.cumsum(is_first)])
    at = chars_before[docs]
    full = np.diff(at) > 0
    codes = np.insert(machine.class_of[points], at[:-1][full], machine.mark)
    return codes, at + np.concatenate([[0], np.cumsum(full)])


_machines: dict[str, Transducer] = {}


def machine_for(model_file: str, max_states: int) -> Transducer:
    """This worker's machine, kept from task to task."""
    if model_file not in _machines:
        _machines[model_file] = Transducer(model_file, max_states)
    return _machines[model_file]


def count_tokens(df: DataFrame, model_file: str, text_col: str = "text", out_col: str = "n_tokens", chunk: int = CHUNK, max_states: int = MAX_STATES) -> DataFrame:
    """df with the number of tokens of each whole text last, as out_col or the next free name."""
    reach_workers(df.sparkSession)
    inner = [f"c{k}" for k in range(len(df.columns))]
    own = df.toDF(*inner)
    text = inner[df.columns.index(text_col)]

    def run(batches):
        machine = machine_for(model_file, max_states)
        for batch in batches:
            counts = [np.zeros(0, np.int64)]
            for _, _, data, docs in W.slices(batch.column(batch.schema.names.index(text)), SLICE_BYTES):
                counts.append(machine.count(*codes_of(machine, data, docs), chunk))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(counts))], names=[*inner, "n"])

    out = own.mapInArrow(run, StructType(list(own.schema.fields)).add("n", "long"))
    return out.select(*[F.col(c).alias(n) for c, n in zip(inner, df.columns, strict=True)], F.col("n").alias(W.free(out_col, df.columns)))
