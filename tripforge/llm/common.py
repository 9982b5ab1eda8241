"""Helpers shared by the operators of this package.

Words are runs of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; every byte
of that set is ASCII, so splitting UTF-8 bytes equals splitting code points.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.session import checkpoint_dir

WORD_BREAK = r"[\x20\x09-\x0D]+"
#: UTF-8 bytes handled in one numpy step; one longer text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(col: str, mod: int):
    """``crc32(col as text) mod mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def stored(df: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """Cut lineage: write under ``spark.checkpoint.dir`` and read back. ``plain``: values hardly repeat, no dictionaries."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    (df.write.option("parquet.enable.dictionary", "false") if plain else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, limit: int, key: str, seed: str):
    """At most ``limit`` rows, the same on every run: those whose seeded key
    hash is smallest. A hash threshold from the row count comes first, so only
    about ``1.5 * limit`` rows meet in the final top-k."""
    n = df.count()
    h = F.xxhash64(F.lit(seed), F.col(key).cast("string"))
    df = df.withColumn("_h", h)
    if n > 2 * limit:
        span = int(min(1.0, (1.3 * limit + 200) / n) * 2**64)
        df = df.filter(F.col("_h") < min(-(2**63) + span, 2**63 - 1))
    return df.orderBy("_h", key).limit(limit).drop("_h")


# ------------------------------------------------------ memory of workers
def release_memory() -> None:
    """Freed memory goes back to the system; Spark keeps idle Python workers, which would hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def released(run):
    """``run`` for mapInArrow, with freed memory given back after each task."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about 4 * STEP_BYTES of ``column`` each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    lo = 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 4 * STEP_BYTES, "left")) + 1
        yield batch.slice(lo, hi - lo)
        lo = hi


# --------------------------------------------------------- numbered strings
class Numbers(dict):
    """Numbers of strings in the order they are first asked for; ``new`` collects those not yet dealt with."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places ``begin[i] .. begin[i] + count[i] - 1`` for each i in turn."""
    ends = np.cumsum(count)
    return np.repeat(begin - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


# ------------------------------------------------------------- word hashing
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def place_factors(n: int) -> np.ndarray:
    """Unrelated odd factors for the places of an n-gram."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _BYTE[7]) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order (A-Z lower-cased), and
    the words' bounds: words of text i are ``[bounds[i], bounds[i + 1])``."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(x) + 1 for x in raw], dtype=np.int64)
    b = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    word = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(word, prepend=False))
    starts, stops = edge[::2], edge[1::2]
    up, down = _powers(len(b) + 1)
    v = _BYTE[b]
    v *= up[: len(b)]
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(v, out=total[1:])
    h = mix64((total[stops] - total[starts]) * down[starts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    return h, bounds


def text_steps(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of ``texts`` of about ``size`` bytes each, with their first row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    lo = 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "left")) + 1
        yield lo, texts.slice(lo, hi - lo).to_pylist()
        lo = hi
