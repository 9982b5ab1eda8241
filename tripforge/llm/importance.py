"""Operator 11: resampling documents towards a target text distribution.

1. Hashed features: runs of consecutive words are hashed into buckets, counted
   per step with numpy and added up per bucket, for the documents and for the target.
2. A bucket's gain is the scaled logarithm of its smoothed share in the target
   over that in the documents, one number in an array that every task gets. A
   document's weight is the floored mean of the gains of its features.
3. A seeded Gumbel number per document turns weights into sampling keys: the
   highest keys are a draw without replacement, weighted by the exponential.
4. The cutoff key is selected by a weighted median of medians: every partition
   gives the median of its remaining keys, the median of these weighted by the
   sizes is the pivot, and counting the keys around the pivot discards at least
   a quarter of them, with a guarantee. One job a round counts around the pivot and
   gives both sides' medians for the next one. It ends when the pivot is the cutoff.
5. Only the winners are sorted, by range partitions; ranks are partition offsets
   plus places.

Defined results: a null text has no words; a document without features has weight 0;
a null doc_id counts as the empty text in the draw, and stands last in ties.
Equal rows are drawn one by one and get ranks of their own; rows of equal score and
doc_id are ordered by n_features. An empty target or an empty table gives gains
from the smoothing alone. Other columns are kept; the new ones replace columns of
the same name. Texts are processed whole.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.common import pieces, released, stored, text_steps

BUCKETS, LONGEST_RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
#: Words whose buckets a worker remembers; when full, the memory starts anew.
MEMO = 400_000
#: A-Z to lower case, bytes of no word to blanks; all bytes above 127 are word bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words ``[0-9a-z\\x80-]+`` of a text, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Buckets(dict):
    """Buckets of features seen before."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        b = zlib.crc32(feature) % self.buckets
        if len(feature) <= 64:
            self[feature] = b
        return b


def feature_buckets(texts: list[str | None], longest: int, known: _Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of ``texts``, number of features and of words of each."""
    numbers, features, words = [], [], []
    for t in texts:
        w = words_of(t)
        before = len(numbers)
        numbers += map(known.__getitem__, w)
        for n in range(2, longest + 1):
            numbers += [known[b" ".join(w[i: i + n])] for i in range(len(w) - n + 1)]
        features.append(len(numbers) - before)
        words.append(len(w))
    return np.array(numbers, np.int64), np.array(features, np.int64), np.array(words, np.int64)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How often each bucket occurs in all of ``docs``. Partitions send at most one row a bucket."""

    def run(batches):
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in text_steps(b.column(0)):
                total += np.bincount(feature_buckets(texts, longest, known)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    counted = docs.select(F.col(text)).mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed target share over the source's) by bucket."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _gumbel(seed: str, doc_id) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST_RUN,
          seed: str = SEED, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score``."""
    names = ["n_words", "n_features", "weight", "score"]
    kept = [c for c in docs.columns if c not in names and (keep_text or c != text)]
    quoted = [f"`{c.replace('`', '``')}`" for c in kept]
    d = docs.select(*quoted, *([] if keep_text else [F.col(text)]))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    schema = T.StructType([*d.schema.fields[: len(kept)], *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches):
        array = shared.value
        known = _Buckets(len(array))
        for b in batches:
            for s in pieces(b, text):
                made, ids = [[], [], [], []], s.column(doc_id)
                for lo, texts in text_steps(s.column(text)):
                    found, features, words = feature_buckets(texts, longest, known)
                    total = np.concatenate([[0], np.cumsum(array[found])])
                    ends = np.cumsum(features)
                    weight = (total[ends] - total[ends - features]) // np.maximum(features, 1)
                    draw = [_gumbel(seed, i) for i in ids.slice(lo, len(texts)).to_pylist()]
                    for column, values in zip(made, (words, features, weight, weight + np.array(draw, np.int64))):
                        column.append(values)
                columns = [s.column(c) for c in kept] + [pa.array(np.concatenate(m), pa.int64()) for m in made]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return d.mapInArrow(released(run), schema)


# -------------------------------------------------------------------- selection
#: Columns of a key: highest score first, then smallest id (null last), then fewest features.
KEY = ("down", "last", "id", "features")


def _with_key(scored: DataFrame, doc_id: str, least_words: int) -> DataFrame:
    """The key beside each row, which is one struct so that no names clash, and whether it takes part."""
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in scored.columns if c != "rank"])
    return scored.select(row.alias("row"), (-F.col("score")).alias("down"), F.col(doc_id).isNull().cast("long").alias("last"),
                         F.coalesce(F.col(doc_id), F.lit(0)).cast("long").alias("id"), F.col("n_features").alias("features"),
                         (F.col("n_words") >= least_words).alias("fit"))


def _before(pivot: tuple) -> F.Column:
    """Whether a row's key stands before ``pivot``."""
    out = F.lit(False)
    for name, value in reversed(list(zip(KEY, pivot))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def _same(pivot: tuple) -> F.Column:
    out = F.lit(True)
    for name, value in zip(KEY, pivot):
        out &= F.col(name) == value
    return out


def _middles(keys: np.ndarray) -> list[tuple]:
    """The lower median of sorted key rows, none if there are none."""
    return [tuple(keys[(len(keys) - 1) // 2].tolist())] if len(keys) else []


def _summaries(keys: DataFrame, pivot: tuple | None) -> list[tuple[int, int, int, tuple | None, tuple | None]]:
    """Per partition: how many keys stand before, at and after the pivot, and the
    medians of the first and the last of these. Without a pivot all stand before."""

    def run(batches: Iterator[pa.RecordBatch]):
        parts = [np.stack([c.to_numpy() for c in b.columns], 1) for b in batches if b.num_rows]
        if parts:
            rows = np.concatenate(parts)
            rows = rows[np.lexsort(rows.T[::-1])]
            lo = hi = len(rows)
            if pivot is not None:
                # lexicographic places of the pivot: narrow the equal range column by column
                lo = 0
                for k, value in enumerate(pivot):
                    column = rows[lo:hi, k]
                    lo, hi = lo + int(np.searchsorted(column, value, "left")), lo + int(np.searchsorted(column, value, "right"))
            first, last = _middles(rows[:lo]), _middles(rows[hi:])
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in ((lo, pa.int64()), (hi - lo, pa.int64()), (len(rows) - hi, pa.int64()),
                                                     (first[0] if first else None, pa.list_(pa.int64())),
                                                     (last[0] if last else None, pa.list_(pa.int64())))],
                ["before", "at", "after", "first", "last"])

    rows = keys.mapInArrow(released(run), "before long, at long, after long, first array<long>, last array<long>").collect()  # one row a partition
    return [(r["before"], r["at"], r["after"], r["first"] and tuple(r["first"]), r["last"] and tuple(r["last"])) for r in rows]


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The first key at which half of the weight is reached."""
    half, run = sum(w for _, w in medians) / 2, 0
    for key, w in sorted(medians):
        run += w
        if run >= half:
            break
    return key


def cutoff(keys: DataFrame, k: int) -> tuple | None:
    """The k-th smallest key row of ``keys`` (KEY columns); None if k is 0.

    ``keys`` is a stored table; bounds found so far are filters on its scan, and
    what remains is written anew when it is less than a quarter of what is read."""
    if k <= 0:
        return None
    found = _summaries(keys, None)
    size = written = sum(f[0] for f in found)
    if k > size:
        raise ValueError("fewer keys than asked for")
    remaining = keys
    medians = [(f[3], f[0]) for f in found if f[3]]
    while True:
        pivot = weighted_median(medians)
        found = _summaries(remaining, pivot)
        before, at = sum(f[0] for f in found), sum(f[1] for f in found)
        if before < k <= before + at:
            return pivot
        if k <= before:
            remaining, size = remaining.filter(_before(pivot)), before
            medians = [(f[3], f[0]) for f in found if f[3]]
        else:
            remaining, size, k = remaining.filter(~_before(pivot) & ~_same(pivot)), size - before - at, k - before - at
            medians = [(f[4], f[2]) for f in found if f[4]]
        if 4 * size < written:
            remaining, written = stored(remaining, "importance-keys"), size


def draw(scored: DataFrame, doc_id: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (a stored table with n_words, n_features, score) with ``rank``:
    1, 2, 3... of the floor(percent * N / 100) highest scores among the N rows with
    at least ``least_words`` words, null for all others."""
    d = _with_key(scored, doc_id, least_words)
    fit = d.filter("fit")
    k = fit.count() * percent // 100
    pivot = cutoff(fit.select(*KEY), k)
    if pivot is None:
        return d.select("row.*", F.lit(None).cast("long").alias("rank"))
    wins = F.col("fit") & (_before(pivot) | _same(pivot))
    # equal keys are told apart by their place, so that they do not meet in one range
    winners = d.filter(wins).withColumn("place", F.monotonically_increasing_id())
    parts = max(1, math.ceil(k / 1_000_000), int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [*KEY, "place"]
    ranged = winners.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")),
                    "importance-winners")
    run, offsets = 0, []
    for p, n in sorted(tuple(r) for r in ranged.groupBy("part").count().collect()):  # one row a partition
        offsets.append((p, run))
        run += n
    offset = d.sparkSession.createDataFrame(offsets, "part int, offset long")
    rank = F.col("offset") + F.col("at") + 1
    won = ranged.join(F.broadcast(offset), "part").select("row", F.when(rank <= k, rank).alias("rank"))
    rest = d.filter(~wins).select("row", F.lit(None).cast("long").alias("rank"))
    return won.unionByName(rest).select("row.*", "rank")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, longest: int = LONGEST_RUN, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: str = SEED, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words, n_features, weight, score, rank`` (rank: null if not drawn)."""
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    scored = stored(weigh(docs, gain, doc_id, text, longest, seed, keep_text), "importance-scored")
    return draw(scored, doc_id, percent, least_words)
