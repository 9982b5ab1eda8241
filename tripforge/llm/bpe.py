"""Operator 5: byte-level BPE encoding and decoding through sentencepiece.

A sentencepiece BPE model is serialised straight from a rank file: the bytes of
each token become one printable character per byte, the piece's score is its
negative rank, and normalisation is the identity. Merging the adjacent pair with
the highest score is then the same as merging the pair of lowest rank. Texts are
cut into pre-tokens by a pattern; each pre-token is encoded by itself. Decoding
strings the characters of the ids' pieces together and maps each back to its byte.

Texts pass in steps of about a megabyte; a worker remembers the ids of pre-tokens
in flat arrays, bounded in number and in characters.

Defined results: a null text counts as empty, an empty text has no ids and
decodes to no bytes. Texts are processed whole. Repeated rows give repeated
rows; other columns are kept, the new ones replace columns of the same name. Null
ids decode to no bytes, ids outside the vocabulary are refused.
"""

from __future__ import annotations

import base64
import hashlib
import struct

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripforge.llm.common import Numbers, pieces, released, spread, text_steps

#: Pre-tokens that a worker remembers, and characters of them; beyond that the memory starts anew.
MEMO, MEMO_CHARACTERS = 300_000, 8 << 20
#: Ids decoded in one step.
STEP_IDS = 1 << 20
#: A vocabulary is broadcast; larger files than this are refused.
MAX_VOCABULARY_BYTES = 64 << 20


def byte_characters() -> list[str]:
    """One character for each byte: printable Latin-1 stays, the rest follow from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from lines of base64 token and rank."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: vocabulary over {MAX_VOCABULARY_BYTES} bytes")
    ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, raw.splitlines())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: piece i has id i and score -i; one unknown piece follows."""
    chars = byte_characters()
    pieces = [_field(1, _field(1, "".join(chars[b] for b in t).encode()) + _field(2, -float(i)) + _field(3, 1))
              for i, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    unk = len(tokens)
    trainer = _field(3, 2) + _field(4, unk + 1) + _field(40, unk) + b"".join(
        _varint(n << 3) + _varint((1 << 64) - 1) for n in (41, 42, 43))  # no bos, eos, pad
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.whole = {t: i for i, t in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self.split = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_char = dict(enumerate(chars))
        # the inverse: characters of all pieces in a row, and the byte of each character
        self.to_byte = np.zeros(max(map(ord, chars)) + 1, np.uint8)
        self.to_byte[[ord(c) for c in chars]] = np.arange(256)
        names = [self.model.id_to_piece(i) for i in range(len(tokens))]
        self.chars = np.frombuffer("".join(names).encode("utf-16-le"), np.uint16)
        self.size_of = np.array([len(p) for p in names], np.int64)
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self._forget()

    def _forget(self) -> None:
        self.known, self.characters = Numbers(), 0
        self.ids, self.begin, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """The ids of the new pre-tokens: a whole token is itself, the rest goes through the model."""
        words, self.known.new = self.known.new, []
        if not words:
            return
        self.characters += sum(map(len, words))
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        single = [self.whole.get(r, -1) for r in raw]
        ids = [[i] for i in single]
        rest = [k for k, i in enumerate(single) if i < 0]
        for k, found in zip(rest, self.model.encode([raw[k].decode("latin-1").translate(self.to_char) for k in rest], num_threads=1)):
            ids[k] = found
        count = np.array([len(i) for i in ids], np.int64)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, np.array([i for found in ids for i in found], np.int32)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and the bounds of each text's ids."""
        if len(self.known) > MEMO or self.characters > MEMO_CHARACTERS:
            self._forget()
        numbers, ends, number = [], [0], self.known.__getitem__
        for t in texts:
            if t:
                numbers += map(number, self.split(t))
            ends.append(len(numbers))
        self._learn()
        n = np.array(numbers, np.int64)
        count = self.count[n]
        return self.ids[spread(self.begin[n], count)], np.concatenate([[0], np.cumsum(count)])[ends]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of ``ids`` between ``bounds``."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.size_of)):
            raise ValueError("ids outside the vocabulary")
        sizes = self.size_of[ids]
        raw = self.to_byte[self.chars[spread(self.start_of[ids], sizes)]].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


_CODECS: dict[str, Codec] = {}


def _shared(docs: DataFrame, vocabulary: str, pattern: str) -> Callable[[], Codec]:
    """A function that gives a worker its codec; the driver reads and broadcasts the rank file."""
    tokens = read_ranks(vocabulary)
    key = hashlib.sha256(repr((pattern, tokens)).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def codec() -> Codec:
        if key not in _CODECS:
            _CODECS.clear()
            _CODECS[key] = Codec(shared.value, pattern)
        return _CODECS[key]

    return codec


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a list column without nulls, and their bounds."""
    lists = [[i for i in r or [] if i is not None] for r in column.to_pylist()]
    return np.array([i for r in lists for i in r], np.int64), np.concatenate([[0], np.cumsum([len(r) for r in lists])]).astype(np.int64)


def _mapped(docs: DataFrame, new: list[T.StructField], steps, make) -> DataFrame:
    """``docs`` with the columns ``new``, which ``make(record batch)`` gives for a step."""
    names = [f.name for f in new]
    kept = [c for c in docs.columns if c not in names]
    d = docs.select(*[f"`{c.replace('`', '``')}`" for c in kept])

    def run(batches):
        for b in batches:
            for s in steps(b.select(kept)):
                yield pa.RecordBatch.from_arrays([*s.columns, *make(s)], [*kept, *names])

    return d.mapInArrow(released(run), T.StructType([*d.schema.fields, *new]))


def _text_slices(text: str):
    def cut(batch):
        for part in pieces(batch, text):
            for lo, texts in text_steps(part.column(text)):
                yield part.slice(lo, len(texts))
    return cut


def _id_slices(ids: str):
    def cut(batch):
        sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(sizes + 1, dtype=np.int64), 0
        while lo < len(ends):
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP_IDS, "left")) + 1
            yield batch.slice(lo, hi - lo)
            lo = hi
    return cut


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text``. ``vocabulary`` is a rank file the driver reads."""
    if ids == text:
        raise ValueError("the ids need a column of their own")
    codec = _shared(docs, vocabulary, pattern)
    return _mapped(docs, [T.StructField(ids, T.ArrayType(T.IntegerType()))], _text_slices(text),
                   lambda s: [_lists(*codec().encode(s.column(text).to_pylist()))])


def decode(docs: DataFrame, vocabulary: str, pattern: str = "", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that ``ids`` stand for; null ids give no bytes."""
    if ids == out:
        raise ValueError("the bytes need a column of their own")
    codec = _shared(docs, vocabulary, pattern)
    return _mapped(docs, [T.StructField(out, T.BinaryType())], _id_slices(ids),
                   lambda s: [pa.array(codec().decode(*_flat(s.column(ids))), pa.binary())])


def encode_checked(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and whether the ids decode to the text
    (``round_trip``), in one pass."""
    codec = _shared(docs, vocabulary, pattern)
    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    if text in [f.name for f in new]:
        raise ValueError("the text needs a column of its own")

    def make(s):
        texts = s.column(text).to_pylist()
        ids, bounds = codec().encode(texts)
        back = codec().decode(ids, bounds)
        same = [b == (t or "").encode("utf-8", "surrogatepass") for b, t in zip(back, texts)]
        return [_lists(ids, bounds), pa.array(np.diff(bounds), pa.int64()), pa.array(same, pa.bool_())]

    return _mapped(docs, new, _text_slices(text), make)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: token count and digests of its ids and of the bytes decoded
    from them. One pass in steps of about a megabyte; ids never leave the task."""
    own_codec = _shared(docs, vocabulary, pattern)

    def sha(raw: bytes) -> str:
        return hashlib.sha256(raw).hexdigest()

    def run(batches):
        codec = own_codec()
        digits = [str(i) for i in range(len(codec.size_of))].__getitem__
        for b in batches:
            for lo, texts in text_steps(b.column("text")):
                ids, bounds = codec.encode(texts)
                names, cuts = list(map(digits, ids.tolist())), bounds.tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, len(texts)), pa.array(np.diff(bounds), pa.int64()),
                     pa.array([sha(" ".join(names[x:y]).encode()) for x, y in zip(cuts, cuts[1:])], pa.string()),
                     pa.array([sha(t) for t in codec.decode(ids, bounds)], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(released(run), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
