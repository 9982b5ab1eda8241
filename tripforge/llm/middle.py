"""Operator 12: fill-in-middle transformation by block rotation in place.

A text is scanned for its units (a word with the blanks before it, or blanks at
the end). Two cuts between units make prefix, middle and suffix. The three
sentinels are inserted in a bytearray, which then holds
``<P>prefix<M>middle<S>suffix``; exchanging two neighbouring blocks by three
reversals gives ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm). ``restore`` finds the sentinels, inverts
the rotation and takes them out.

Cuts and form come from the sha256 of ``seed:doc_id``, so reruns agree. A text
that is empty or holds a sentinel stays plain, so the sentinels of an output are
always those inserted.

Defined results: a null text counts as empty, a null doc_id as no digits. Texts
are processed whole. Repeated rows give repeated rows; other columns are kept, the
new ones replace columns of the same name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripforge.llm.common import pieces, released, text_steps

#: Sentinels of prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of texts that are transformed, and of those the percent in spm form.
FIM_PERCENT, SPM_PERCENT = 50, 80
SEED = 42
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def unit_ends(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of all texts in bytes of their text, and the bounds of
    each text's ends: unit k of text i ends at ``ends[bounds[i] + k]``."""
    sizes = np.array([len(t) for t in texts], np.int64)
    after = np.cumsum(sizes + 1)
    b = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[b]
    stops = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    # blanks at the end of a text are a unit of their own
    tail = np.flatnonzero((sizes > 0) & blank[np.maximum(after - 2, 0)])
    ends = np.sort(np.concatenate([stops, after[tail] - 1]), kind="stable")
    owner = np.searchsorted(after - 1, ends, "left")
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return ends - (after - sizes - 1)[owner], bounds


def rotate(buf: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange the blocks ``buf[lo:mid]`` and ``buf[mid:hi]`` by three reversals."""
    for a, b in ((lo, mid), (mid, hi), (lo, hi)):
        part = buf[a:b]
        part.reverse()
        buf[a:b] = part


def transform_bytes(raw: bytes, cut: int, second: int, form: str) -> bytes:
    """``raw`` with sentinels, its blocks in the order of ``form``."""
    if form == "plain":
        return raw
    buf = bytearray(raw)
    for at, mark in ((second, SUFFIX), (cut, MIDDLE), (0, PREFIX)):  # from the back, so places stay valid
        buf[at:at] = mark
    middle, suffix = cut + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def restore_bytes(out: bytes, form: str) -> bytes:
    """The text of an output: the rotation inverted, the sentinels taken out."""
    if form == "plain":
        return out
    buf = bytearray(out)
    suffix, prefix, middle = out.find(SUFFIX), out.find(PREFIX), out.find(MIDDLE)
    if form == "psm":
        rotate(buf, suffix, middle, len(buf))
        marks = (suffix + len(buf) - middle, SUFFIX), (suffix, MIDDLE), (prefix, PREFIX)
    else:
        rotate(buf, 0, prefix, len(buf))
        marks = (len(buf) - prefix, SUFFIX), (middle - prefix, MIDDLE), (0, PREFIX)
    for at, mark in marks:
        if buf[at: at + len(mark)] != mark:
            raise ValueError(f"no {mark.decode()} where the form {form} has it")
        del buf[at: at + len(mark)]
    return bytes(buf)


def _draws(seed: int, doc_id) -> list[int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[k: k + 8], 16) for k in (0, 8, 16, 24)]


def _characters(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(raw.decode("utf-8", "surrogatepass"))


def _transform(ids: list, texts: list[str | None], seed: int, fim_percent: int, spm_percent: int) -> list[tuple]:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends, bounds = unit_ends(raw)
    rows = []
    for i, (doc_id, t) in enumerate(zip(ids, raw)):
        first, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
        h1, h2, h3, h4 = _draws(seed, doc_id)
        if not t or PREFIX in t or SUFFIX in t or MIDDLE in t or h3 % 100 >= fim_percent:
            rows.append((n, "plain", None, None, t))
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        cut, second = (int(ends[first + k - 1]) if k else 0 for k in (a, b))
        form = "spm" if h4 % 100 < spm_percent else "psm"
        rows.append((n, form, _characters(t[:cut]), _characters(t[cut:second]), transform_bytes(t, cut, second, form)))
    return rows


def _quoted(names) -> list[str]:
    return [f"`{c.replace('`', '``')}`" for c in names]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", output: str = "output", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``
    (code points; null if plain) and ``output``."""
    new = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
           T.StructField("middle_chars", T.LongType()), T.StructField(output, T.StringType())]
    names = [f.name for f in new]
    if {doc_id, text} & set(names) or len(set(names)) < len(names):
        raise ValueError("the new columns need names of their own")
    kept = [c for c in docs.columns if c not in names]
    d = docs.select(*_quoted(kept))

    def run(batches):
        for b in batches:
            for s in pieces(b, text):
                rows, ids = [], s.column(doc_id)
                for lo, texts in text_steps(s.column(text)):
                    rows += _transform(ids.slice(lo, len(texts)).to_pylist(), texts, seed, fim_percent, spm_percent)
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()])]
                yield pa.RecordBatch.from_arrays([*s.columns, *made], [*kept, *names])

    return d.mapInArrow(released(run), T.StructType([*d.schema.fields, *new]))


def restore(docs: DataFrame, output: str = "output", form: str = "form", restored: str = "restored") -> DataFrame:
    """``docs`` with the text rebuilt from ``output`` and ``form`` (null output: empty)."""
    if restored in (output, form):
        raise ValueError("the restored text needs a column of its own")
    kept = [c for c in docs.columns if c != restored]
    d = docs.select(*_quoted(kept))

    def run(batches):
        for b in batches:
            for s in pieces(b, output):
                back = []
                for lo, texts in text_steps(s.column(output)):
                    forms = s.column(form).slice(lo, len(texts)).to_pylist()
                    back += [restore_bytes((t or "").encode("utf-8", "surrogatepass"), f or "plain") for t, f in zip(texts, forms)]
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(back, pa.string())], [*kept, restored])

    return d.mapInArrow(released(run), T.StructType([*d.schema.fields, T.StructField(restored, T.StringType())]))
