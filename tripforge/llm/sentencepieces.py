"""Operator 13: SentencePiece BPE encoding and decoding by vectorised merge rounds.

A model file is read field by field into its pieces. A text is escaped (a dummy
prefix, spaces as U+2581) and cut into words at places that no piece covers, so
every word can be merged by itself. The words of many texts lie in one flat numpy
array of symbols. Each round takes the smallest rank of an adjacent pair in every
word, merges all its places at once from the left, and looks up the pairs
that this made; dead symbols are compacted away; the rounds end when no word has a
pair of the vocabulary. Characters without a piece become their UTF-8 bytes' pieces.

One pair at a time, best score first and leftmost among equals, is the library's
rule. Rounds equal it except where a merge makes a better pair than its own while
the same rank stands elsewhere in the word, or where different pieces have one
score (runs of blanks); such words are found and merged one pair at a time.

Defined results: a null text counts as empty, an empty text has no ids and
decodes to the empty text; null ids decode to the empty text. U+2581 in a text
decodes to a space, as the library has it. Texts are processed whole. Repeated
rows give repeated rows; other columns are kept, the new ones replace columns of
the same name.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripforge.llm.common import Numbers, released, spread, text_steps
from tripforge.llm.common import pieces as slices

SPACE = "▁"
#: A vocabulary is broadcast; larger files than this are refused.
MAX_MODEL_BYTES = 64 << 20
#: Words that a worker remembers, and characters of them; beyond that the memory starts anew.
MEMO, MEMO_CHARACTERS = 300_000, 8 << 20
#: No pair: larger than any rank.
NONE = np.int32(2**31 - 1)
#: A symbol without a piece is this plus its code point.
LOOSE = 1 << 20
#: Piece kinds and normaliser fields of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Code points.
UNICODE = 0x110000


# ------------------------------------------------------------------ model file
def _fields(raw: bytes):
    """(number, value) of each protobuf field: int, bytes, or 4-byte float."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, raw[at: at + n]
            at += n
        elif key & 7 == 5:
            yield key >> 3, struct.unpack("<f", raw[at: at + 4])[0]
            at += 4
        else:
            yield key >> 3, raw[at: at + 8]
            at += 8


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id. Refuses what the rounds do not cover: other
    model types, a character map, user-defined pieces, no byte pieces."""
    with open(path, "rb") as f:
        raw = f.read(MAX_MODEL_BYTES + 1)
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: model over {MAX_MODEL_BYTES} bytes")
    found, trainer, normaliser = [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            p = dict(_fields(value))
            found.append((p[1].decode(), p.get(2, 0.0), p.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    as_expected = (trainer.get(3, 1) == 2 and not trainer.get(24, 0) and not normaliser.get(2) and normaliser.get(3, 1)
                   and not normaliser.get(4, 1) and normaliser.get(5, 1))
    if not as_expected or {k for _, _, k in found} - {NORMAL, UNKNOWN, CONTROL, BYTE} or sum(k == BYTE for _, _, k in found) != 256:
        raise ValueError(f"{path}: needs a BPE model with byte pieces, a dummy prefix, identity normalisation and no user-defined pieces")
    return found


# ----------------------------------------------------------------- lookup tables
class Pairs:
    """Values of (left, right) symbol pairs by open addressing in flat arrays."""

    def __init__(self, left, right, value):
        keys = self._keys(np.asarray(left, np.int64), np.asarray(right, np.int64))
        self.bits = max(10, int(len(keys) * 4).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.full(1 << self.bits, NONE, np.int32)
        values, at, self.probes = np.asarray(value, np.int32), self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.key[at] < 0
            self.key[at[free]] = keys[free]  # of several, the last one stays
            in_place = self.key[at] == keys
            self.value[at[in_place]] = values[in_place]
            keys, values, at = keys[~in_place], values[~in_place], (at[~in_place] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left << 22 | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._keys(left.astype(np.int64), right.astype(np.int64))
        at = self._slot(keys)
        out = np.where(self.key[at] == keys, self.value[at], NONE)
        left_over = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(left_over):
                break
            at[left_over] = (at[left_over] + 1) & ((1 << self.bits) - 1)
            here = self.key[at[left_over]]
            out[left_over] = np.where(here == keys[left_over], self.value[at[left_over]], NONE)
            left_over = left_over[(here != keys[left_over]) & (here >= 0)]
        return out


class Vocabulary:
    """Tables of one model."""

    def __init__(self, model: list[tuple[str, float, int]]):
        self.size = len(model)
        normal = {p: i for i, (p, _, k) in enumerate(model) if k == NORMAL}
        scores = sorted({model[i][1] for i in normal.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        self.symbol = np.arange(UNICODE, dtype=np.int32) + LOOSE
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        #: The piece of a rank; ranks of several pieces are tied.
        self.piece_of = np.full(len(scores), -1, np.int32)
        self.tied = np.zeros(len(scores), bool)
        left, right, ranks, ids, first, second = [], [], [], [], [], []
        for p, i in normal.items():
            r = rank_of[model[i][1]]
            if len(p) > 1:
                self.tied[r] |= self.piece_of[r] >= 0
                self.piece_of[r] = i
            for k in range(1, len(p)):
                first.append(ord(p[k - 1]))
                second.append(ord(p[k]))
                a = normal.get(p[:k], int(self.symbol[ord(p[0])]) if k == 1 else None)
                b = normal.get(p[k:], int(self.symbol[ord(p[-1])]) if k == len(p) - 1 else None)
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    ranks.append(r)
                    ids.append(i)
        self.ranks = Pairs(left, right, ranks)
        self.merged = {(a, b): (r, i) for a, b, r, i in zip(left, right, ranks, ids)}
        both = sorted(set(zip(first, second)))
        #: Neighbouring characters inside some piece; words are cut between all others.
        self.inside = Pairs([a for a, _ in both], [b for _, b in both], [1] * len(both))
        #: Whether the place before a run of blanks is such a cut.
        self.cut_at_blanks = not any(b == ord(SPACE) != a for a, b in both)
        self.byte_id = np.zeros(256, np.int32)
        for i, (p, _, k) in enumerate(model):
            if k == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        self.surface = [p.replace(SPACE, " ").encode() if k == NORMAL else bytes([int(p[3:5], 16)]) if k == BYTE else
                        " ⁇ ".encode() if k == UNKNOWN else b"" for p, _, k in model]
        self.bos_blank = [k == NORMAL and p.startswith(SPACE) for p, _, k in model]


# ------------------------------------------------------------------ merging
def merge_one_by_one(symbols: list[int], merged: dict) -> list[int]:
    """The library's rule: best score first, leftmost among equals."""
    n = len(symbols)
    sym, nxt, prv = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (hit := merged.get((sym[i], sym[j]))):
            heapq.heappush(heap, (hit[0], i, sym[i], sym[j], hit[1]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, a, b, piece = heapq.heappop(heap)
        j = nxt[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue
        sym[i], sym[j], nxt[i] = piece, -1, nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        offer(prv[i], i)
        offer(i, nxt[i])
    return [s for s in sym if s >= 0]


def merge_rounds(codes: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words of code points (word i is ``codes[bounds[i]:bounds[i+1]]``,
    none empty) after all merges, and their words' numbers."""
    n = len(codes)
    start = np.zeros(n, bool)
    start[bounds[:-1]] = True
    word = np.cumsum(start) - 1
    # parts: words cut further where no piece covers both neighbours
    start[1:] |= v.inside.get(codes[:-1], codes[1:]) == NONE
    part = np.cumsum(start) - 1
    first = v.symbol[codes]
    done: list[tuple[np.ndarray, np.ndarray]] = []

    sym, place = first.copy(), np.arange(n)  # place: the symbol's first code point
    one_by_one = np.zeros(part[-1] + 1 if n else 0, bool)
    while len(sym):
        # a flat array of the parts that still have a pair; links skip dead symbols
        own = part[place]
        head = np.flatnonzero(np.diff(own, prepend=-1))
        local = np.cumsum(np.diff(own, prepend=own[0]) != 0)
        last = np.zeros(len(sym), bool)
        last[np.append(head[1:], len(sym)) - 1] = True
        nxt = np.where(last, -1, np.arange(1, len(sym) + 1))
        prv = np.arange(-1, len(sym) - 1)
        prv[head] = -1
        rank = np.full(len(sym), NONE, np.int32)
        left = np.flatnonzero(~last)
        rank[left] = v.ranks.get(sym[left], sym[left + 1])
        live = len(sym)
        while True:
            least = np.minimum.reduceat(rank, head)
            ties = np.flatnonzero((least < NONE) & v.tied[np.minimum(least, len(v.tied) - 1)])
            if len(ties):
                one_by_one[own[head[ties]]] = True
                rank[np.isin(local, ties)] = NONE
                continue
            hot = np.flatnonzero((rank == least[local]) & (rank < NONE))
            if not len(hot):
                break
            # of overlapping places, every second from the left
            chained = np.zeros(len(hot), bool)
            chained[1:] = nxt[hot[:-1]] == hot[1:]
            at = np.arange(len(hot))
            hot = hot[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]
            own_rank, several = rank[hot], np.bincount(local[hot], minlength=len(head))[local[hot]] > 1
            right, made = nxt[hot], v.piece_of[rank[hot]]
            after = nxt[right]
            # a pair that stands only until the next place is merged
            soon = np.flatnonzero(several[:-1] & (after[:-1] == hot[1:]))
            unsafe = [local[hot[soon[v.ranks.get(made[soon], sym[after[soon]]) < own_rank[soon]]]]] if len(soon) else []
            sym[hot], sym[right], rank[right] = made, -1, NONE
            nxt[hot] = after
            inner = after >= 0
            prv[after[inner]] = hot[inner]
            before = prv[hot]
            rank[hot] = NONE
            a, b = hot[inner], after[inner]
            rank[a] = v.ranks.get(sym[a], sym[b])
            b = before[before >= 0]
            rank[b] = v.ranks.get(sym[b], sym[nxt[b]])
            worse = several & (np.minimum(rank[hot], np.where(before >= 0, rank[before], NONE)) < own_rank)
            unsafe.append(local[hot[worse]])
            unsafe = np.unique(np.concatenate(unsafe))
            if len(unsafe):
                one_by_one[own[head[unsafe]]] = True
                rank[np.isin(local, unsafe)] = NONE
            live -= len(hot)
            if live < 0.75 * len(sym):
                break
        # compaction: finished parts leave, dead symbols go
        least = np.minimum.reduceat(rank, head)
        alive, more = sym >= 0, (least < NONE)[local]
        done.append((place[alive & ~more], sym[alive & ~more]))
        place, sym = place[alive & more], sym[alive & more]

    at = np.concatenate([p for p, _ in done]) if done else np.zeros(0, np.int64)
    out = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
    if one_by_one.any():
        keep = ~one_by_one[part[at]]
        at, out = [at[keep]], [out[keep]]
        edges = np.append(np.flatnonzero(start), n)
        for p in np.flatnonzero(one_by_one):
            got = merge_one_by_one(first[edges[p]: edges[p + 1]].tolist(), v.merged)
            at.append(np.arange(edges[p], edges[p] + len(got)))
            out.append(np.array(got, np.int32))
        at, out = np.concatenate(at), np.concatenate(out)
    order = np.argsort(at, kind="stable")
    return out[order], word[at[order]]


_EACH_BYTE = "sentencepieces_each_byte"
codecs.register_error(_EACH_BYTE, lambda e: ("�", e.start + 1))


class Coder:
    """Encoder and decoder of one worker. Words met before keep their ids in flat arrays."""

    def __init__(self, model: list[tuple[str, float, int]]):
        self.v = v = Vocabulary(model)
        self.split = re.compile(f"{SPACE}+[^{SPACE}]*").findall if v.cut_at_blanks else lambda text: [text]
        self.bytes_of = np.frombuffer(b"".join(v.surface), np.uint8)
        self.size_of = np.array([len(x) for x in v.surface], np.int64)
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self._forget()

    def _forget(self) -> None:
        self.words = Numbers()
        self.characters = 0
        self.ids, self.begin, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """The ids of the new words."""
        v, words, self.words.new = self.v, self.words.new, []
        if not words:
            return
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.characters += len(codes)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        sym, word = merge_rounds(codes, bounds, v)
        if len(loose := np.flatnonzero(sym >= LOOSE)):
            # a character without a piece becomes the pieces of its bytes
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[loose] - LOOSE).tolist()]
            sizes = np.ones(len(sym), np.int64)
            sizes[loose] = [len(r) for r in raw]
            begin = np.cumsum(sizes) - sizes
            sym, word = np.repeat(sym, sizes), np.repeat(word, sizes)
            sym[spread(begin[loose], sizes[loose])] = v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        count = np.bincount(word, minlength=len(words))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, sym.astype(np.int32)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and the bounds of each text's ids."""
        if len(self.words) > MEMO or self.characters > MEMO_CHARACTERS:
            self._forget()
        numbers, ends, number = [], [], self.words.__getitem__
        for t in texts:
            if t:
                numbers += map(number, self.split(SPACE + t.replace(" ", SPACE)))
            ends.append(len(numbers))
        self._learn()
        n = np.array(numbers, np.int64)
        count = self.count[n]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.ids[spread(self.begin[n], count)], total[np.concatenate([[0], ends]).astype(np.int64)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ``ids`` between ``bounds``; an invalid byte becomes U+FFFD."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.v.size):
            raise ValueError("ids outside the vocabulary")
        sizes = self.size_of[ids]
        raw = self.bytes_of[spread(self.start_of[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        out = []
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            # the blank of the dummy prefix, if the first id with a text has one
            if a < b and raw[a] == 32:
                k = int(bounds[i])
                while not sizes[k]:
                    k += 1
                a += self.v.bos_blank[ids[k]]
            out.append(raw[a:b].decode("utf-8", _EACH_BYTE))
        return out


_CODERS: dict[str, Coder] = {}


def _shared(docs: DataFrame, model_file: str):
    """A function that gives a worker its coder; the driver reads and broadcasts the model."""
    model = read_model(model_file)
    key = hashlib.sha256(repr(model).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def coder() -> Coder:
        if key not in _CODERS:
            _CODERS.clear()
            _CODERS[key] = Coder(shared.value)
        return _CODERS[key]

    return coder


# ------------------------------------------------------------------- operators
def _appended(docs: DataFrame, name: str, kind: T.DataType, column: str, rows, size) -> DataFrame:
    """``docs`` with the column ``name`` of ``rows(record batch) -> pyarrow array``,
    a few megabytes of ``column`` at a time."""
    kept = [c for c in docs.columns if c != name]
    d = docs.select(*[f"`{c.replace('`', '``')}`" for c in kept])
    schema = T.StructType([*d.schema.fields, T.StructField(name, kind)])

    def run(batches):
        for b in batches:
            for s in size(b, column):
                yield pa.RecordBatch.from_arrays([*s.columns, rows(s)], [*kept, name])

    return d.mapInArrow(released(run), schema)


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text``. ``model_file`` is read by the driver."""
    if ids == text:
        raise ValueError("the ids need a column of their own")
    own_coder = _shared(docs, model_file)

    def rows(batch: pa.RecordBatch) -> pa.Array:
        coder, parts = own_coder(), []
        for _, texts in text_steps(batch.column(text)):
            found, bounds = coder.encode(texts)
            parts.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return _appended(docs, ids, T.ArrayType(T.IntegerType()), text, rows, slices)


def decode(docs: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids`` stand for."""
    if ids == out:
        raise ValueError("the text needs a column of its own")
    own_coder = _shared(docs, model_file)

    def rows(batch: pa.RecordBatch) -> pa.Array:
        lists = [[i for i in r or [] if i is not None] for r in batch.column(ids).to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in lists])]).astype(np.int64)
        return pa.array(own_coder().decode(np.array([i for r in lists for i in r], np.int64), bounds), pa.string())

    def few(batch: pa.RecordBatch, column: str, ids_at_once: int = 1 << 20):
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 1, dtype=np.int64)
        lo = 0
        while lo < len(ends):
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + ids_at_once, "left")) + 1
            yield batch.slice(lo, hi - lo)
            lo = hi

    return _appended(docs, out, T.StringType(), ids, rows, few)


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: number of ids and digests of the ids and of the text decoded
    from them. One pass in steps of about a megabyte; ids never leave the task."""
    own_coder = _shared(docs, model_file)

    def sha(raw: bytes) -> str:
        return hashlib.sha256(raw).hexdigest()

    def run(batches):
        coder = own_coder()
        digits = [str(i) for i in range(coder.v.size)].__getitem__
        for b in batches:
            for lo, texts in text_steps(b.column("text")):
                ids, bounds = coder.encode(texts)
                back = coder.decode(ids, bounds)
                names = list(map(digits, ids.tolist()))
                cuts = bounds.tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, len(back)), pa.array(np.diff(bounds), pa.int64()),
                     pa.array([sha(",".join(names[x:y]).encode()) for x, y in zip(cuts, cuts[1:])], pa.string()),
                     pa.array([sha(t.encode()) for t in back], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(released(run), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
