"""Operator 1: language-model scores from a log-frequency Bloom filter.

Training counts of words and word pairs are gathered by one grouping over 64-bit
keys. A count is quantised on a logarithmic scale; a key of level q puts the
events (key, 1) ... (key, q) into a Bloom filter, so a reader finds the level by
probing 1, 2, ... until a probe misses. The filter is built in regions of 1 MB by
tasks; their number grows with the events, so the bits per event are the same at
every size. Pieces of at most ``max_filter_mb`` are put together on the driver and
broadcast one by one, and a worker probes them one after another, holding one.

Score of a text: a mixture, per text, of a word model ``(c + 1) / (sum + V + 1)``,
``c`` and ``sum`` both of the quantised counts, so that it sums to one,
and back-off pair models that differ in the mass kept for unseen pairs. Every pair of
the training texts is in the filter. All counts in it come from probes; rounding is downwards
for pairs and upwards for their contexts, so each model sums to at most one, but
for false positives.

Base score: exact add-one word probabilities. Counts of the most frequent words
(a bounded number) are broadcast; rarer words of a document meet their counts in
a join, where no word is hot any more.

Defined results: a null or empty text has one token, the end; with no training
text every word is unknown (N = 0, V = 0); repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import STEP_BYTES, mix64, stored, text_steps, word_hashes

#: Logarithmic scale of counts, bits of a region, bits of filter per event, probes per event.
GROWTH, REGION_BITS, EVENT_BITS, PROBES = 1.4, 1 << 23, 10, 7
#: Most MB of the filter that are broadcast, and held by a worker, as one piece.
MAX_FILTER_MB = 128
#: UTF-8 bytes of text scored together when the filter has several pieces.
PASS_BYTES = 8 << 20
#: Most words whose exact counts are broadcast (16 bytes each).
FREQUENT_WORDS = 200_000
#: Mass kept for unseen pairs by each pair model.
UNSEEN = (0.9, 0.5, 0.1, 0.02)
#: Tokens counted together before a task hands on partial counts.
FLUSH = 1_000_000
#: Probed levels from REMEMBER_FROM on that a worker remembers (16 bytes each).
REMEMBER, REMEMBER_FROM = 400_000, 3

_START, _END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)
_ONE = np.uint64(1)


def _scale() -> np.ndarray:
    t = [1]
    while t[-1] < 1 << 48:
        t.append(max(t[-1] + 1, int(np.ceil(t[-1] * GROWTH))))
    return np.array(t, np.int64)


SCALE = _scale()


def level_of(counts: np.ndarray) -> np.ndarray:
    """Level of each count: how many steps of SCALE it has reached."""
    return np.searchsorted(SCALE, counts, "right")


def lowest(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, SCALE[np.maximum(level, 1) - 1], 0)


def highest(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, SCALE[np.minimum(level, len(SCALE) - 1)] - 1, 0)


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word keys with an end per text, the token before each, and the text's number."""
    h, bounds = word_hashes(texts)
    n = np.diff(bounds)
    cur = np.insert(h | _ONE, bounds[1:], _END)
    doc = np.repeat(np.arange(len(texts)), n + 1)
    before = np.concatenate([[_START], cur[:-1]])
    before[np.concatenate([[0], np.cumsum(n + 1)[:-1]])] = _START
    return cur, before, doc


def pair_keys(before: np.ndarray, cur: np.ndarray) -> np.ndarray:
    """Even keys; words have odd ones."""
    return mix64(before * np.uint64(0xD1342543DE82EF95) + mix64(cur)) & ~_ONE


def count_rows(texts: DataFrame) -> DataFrame:
    """key, c: partial counts of words (odd keys) and pairs (even keys)."""

    def run(batches):
        held, n = [], 0

        def flush():
            k, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], ["key", "c"])

        for b in batches:
            for _, t in text_steps(b.column(0)):
                cur, before, _ = tokens_of(t)
                held += [cur, pair_keys(before, cur)]
                n += len(cur)
                if n >= FLUSH:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "key long, c long")


# ----------------------------------------------------------------- the filter
def _slots(keys: np.ndarray, level: int):
    """The slot of each key's event at ``level``, probe after probe (double hashing)."""
    h = mix64(keys + np.uint64(level * 0x9FB21C651E98DF25 % 2**64))
    step = (h >> np.uint64(40)) | _ONE
    for _ in range(PROBES):
        yield h & np.uint64(REGION_BITS - 1)
        h = h + step


def _region(keys: np.ndarray, regions: int) -> np.ndarray:
    return ((mix64(keys) >> np.uint64(24)) % np.uint64(regions)).astype(np.int64)


def build_filter(counts: DataFrame, regions: int) -> DataFrame:
    """region, bits: the whole filter, each region of REGION_BITS built by a task from its keys."""

    def with_region(batches):
        for b in batches:
            k = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_region(k, regions)), b.column(0), b.column(1)], ["region", "key", "c"])

    def build(key, t):
        bits = np.zeros(REGION_BITS >> 3, np.uint8)
        k = t.column("key").to_numpy().view(np.uint64)
        c = t.column("c").to_numpy()
        q = level_of(c)
        level = 1
        while len(k):
            for s in _slots(k, level):
                np.bitwise_or.at(bits, (s >> np.uint64(3)).astype(np.int64), np.uint8(1) << (s & np.uint64(7)).astype(np.uint8))
            level += 1
            k, q = k[q >= level], q[q >= level]
        return pa.table({"region": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    rows = counts.select("key", "c").mapInArrow(with_region, "region long, key long, c long")
    return rows.groupBy("region").applyInArrow(build, "region long, bits binary")


def broadcast_filter(built: DataFrame, regions: int, most: int) -> list:
    """The filter as broadcast pieces of ``most`` regions; the driver holds one piece at a time."""
    out = []
    for lo in range(0, regions, most):
        bits = np.zeros((min(most, regions - lo), REGION_BITS >> 3), np.uint8)
        for r in built.filter(F.col("region").between(lo, lo + len(bits) - 1)).toLocalIterator():
            bits[r["region"] - lo] = np.frombuffer(r["bits"], np.uint8)
        out.append(built.sparkSession.sparkContext.broadcast(bits))
    return out


def piece_bits(pieces: list):
    """The bits of each piece; a single one stays in memory, of several only the one in use."""
    for p in pieces:
        path = getattr(p, "_path", None)
        yield p.value if len(pieces) == 1 or path is None else p.load_from_path(path)


def probe_levels(keys: np.ndarray, bits: np.ndarray, region: np.ndarray | None = None) -> np.ndarray:
    """Level of each key: probes 1, 2, ... until one misses. ``region`` is the row of ``bits`` of each key."""
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    base = (_region(keys, len(bits)) if region is None else region) * (REGION_BITS >> 3)
    flat = bits.reshape(-1)
    level = 1
    while len(alive) and level <= len(SCALE):
        h = mix64(keys[alive] + np.uint64(level * 0x9FB21C651E98DF25 % 2**64))
        step, at = (h >> np.uint64(40)) | _ONE, base[alive]
        for _ in range(PROBES):
            s = h & np.uint64(REGION_BITS - 1)
            hit = (flat[at + (s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            if not hit.all():
                alive, h, step, at = alive[hit], h[hit], step[hit], at[hit]
            h = h + step
        found[alive] = level
        level += 1
    return found


def probe_pieces(keys: np.ndarray, pieces, regions: int) -> np.ndarray:
    """As probe_levels, with the bits in ``pieces`` of consecutive regions."""
    region, found, first = _region(keys, regions), np.zeros(len(keys), np.int64), 0
    for bits in pieces:
        at = np.flatnonzero((region >= first) & (region < first + len(bits)))
        found[at] = probe_levels(keys[at], bits, region[at] - first)
        first += len(bits)
    return found


class Levels:
    """Levels by probing; a worker remembers those of keys that took many probes.

    ``bits`` is the whole filter, or a function that gives its pieces."""

    def __init__(self, bits, regions: int = 0):
        self.pieces = bits if callable(bits) else lambda: [bits]
        self.regions = regions or len(bits)
        self.keys, self.levels = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """``keys`` must be sorted and distinct."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        out = np.zeros(len(keys), np.int64)
        out[known] = self.levels[at[known]]
        out[~known] = fresh = probe_pieces(keys[~known], self.pieces(), self.regions)
        new = np.flatnonzero(fresh >= REMEMBER_FROM)[: REMEMBER - len(self.keys)]
        if len(new):
            k = np.concatenate([self.keys, keys[~known][new]])
            order = np.argsort(k)
            self.keys, self.levels = k[order], np.concatenate([self.levels, fresh[new]])[order]
        return out


# ---------------------------------------------------------------- the scores
def middle(level: np.ndarray) -> np.ndarray:
    """The count that a word's level stands for; 0 for level 0."""
    return np.sqrt(lowest(level).astype(float) * highest(level))


def score_texts(texts: list[str | None], model: dict, levels: Levels):
    """Per text: tokens, score, partial base sums; and (text, key, n) of words that are not frequent."""
    cur, before, doc = tokens_of(texts)
    size = len(texts)

    def per_doc(x):
        return np.bincount(doc, x, size)

    words, at = np.unique(cur, return_inverse=True)
    pairs, pat = np.unique(pair_keys(before, cur), return_inverse=True)
    keys = np.concatenate([words, pairs])  # one pass over the filter for both
    order = np.argsort(keys)
    both = np.empty(len(keys), np.int64)
    both[order] = levels(keys[order])
    level = both[: len(words)]
    word_log = np.log10(middle(level) + 1) - np.log10(model["mass"] + model["v"] + 1)
    log1 = word_log[at]
    seen_level = both[len(words):][pat]
    seen = seen_level > 0
    pair_count = np.where(seen, lowest(seen_level), 1).astype(float)
    context = np.concatenate([[0], highest(level)[at][:-1]])
    context[before == _START] = model["texts"]
    ratio = np.log10(np.minimum(1.0, pair_count / np.maximum(context, pair_count)))
    n_seen, n_tokens = per_doc(seen), per_doc(np.ones(len(cur)))
    joint = per_doc(np.where(seen, ratio, log1))
    parts = [per_doc(log1)] + [joint + n_seen * np.log10(1 - u) + (n_tokens - n_seen) * np.log10(u) for u in UNSEEN]
    parts = np.stack(parts)
    top = parts.max(0)
    score = top + np.log10(np.power(10.0, parts - top).mean(0))

    f = np.minimum(np.searchsorted(model["words"], words), max(len(model["words"]) - 1, 0))
    known = model["words"][f] == words if len(model["words"]) else np.zeros(len(words), bool)
    count = np.where(known, model["counts"][f] if len(model["counts"]) else 0, 0)
    base = per_doc(np.log10(count + 1.0)[at])
    n_known = per_doc(known[at])
    rest = ~known[at]
    rows = None
    if model["more"] and rest.any():
        d, k = doc[rest], cur[rest]
        order = np.argsort(k, kind="stable")  # texts stay in order within a key
        d, k = d[order], k[order]
        first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]))
        rows = d[first], k[first], np.diff(np.append(first, len(k)))
    return n_tokens, score, base, n_known, rows


def train(texts: DataFrame, max_filter_mb: int = MAX_FILTER_MB) -> tuple[dict, DataFrame]:
    """The broadcast part of the model (the filter in pieces of ``max_filter_mb``), and the exact counts of all words."""
    counts = stored(count_rows(texts).groupBy("key").agg(F.sum("c").alias("c")), "lm-counts")
    is_word = F.col("key").bitwiseAND(1) == 1
    steps_ = F.when(F.col("c") <= 5, F.col("c")).otherwise(5 + F.log(F.col("c") / 5.0) / float(np.log(GROWTH)))
    # the counts of all words as a probe reads them: what the word model's shares add up to
    scale = F.array(*[F.lit(int(x)) for x in SCALE])
    level = F.size(F.filter(scale, lambda x: x <= F.col("c")))
    n, v, events = counts.agg(F.sum(F.when(is_word, F.col("c"))), F.count_if(is_word), F.sum(steps_)).first()
    regions = int((events or 0) * EVENT_BITS // REGION_BITS + 1)
    most = max(1, max_filter_mb * (1 << 23) // REGION_BITS)
    words = stored(counts.filter(is_word), "lm-words")  # few beside the pairs, read several times
    mass = sum(r["words"] * float(middle(np.array([r["level"]]))[0])
               for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy("level").collect())  # one row a level
    # the least logarithmic step that leaves few enough words
    step = F.floor(F.log("c") / float(np.log(GROWTH)))
    least, total = 1 << 62, 0
    for r in words.groupBy(step.alias("s")).agg(F.count("*").alias("words"), F.min("c").alias("c")).orderBy(F.desc("s")).collect():
        total += r["words"]
        if total > FREQUENT_WORDS:
            break
        least = r["c"]
    top = words.filter(F.col("c") >= least).toPandas()
    key = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)
    built = build_filter(counts, regions)
    if regions > most:  # read once per piece
        built = stored(built, "lm-filter")
    return {"filter": broadcast_filter(built, regions, most), "regions": regions, "n": int(n or 0), "v": int(v or 0), "mass": mass, "texts": texts.count(),
            "words": key[order], "counts": top["c"].to_numpy(np.int64)[order], "more": int(v or 0) > len(key)}, words


def score(docs: DataFrame, model: dict, words: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    pieces = model["filter"]
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "filter"})
    at_once = STEP_BYTES if len(pieces) == 1 else PASS_BYTES
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = shared.value
        if "levels" not in model:  # of this worker's copy
            model["levels"] = Levels(lambda: piece_bits(pieces), model["regions"])
        levels = model["levels"]
        for b in batches:
            for lo, t in text_steps(b.column("text"), at_once):
                hi = lo + len(t)
                n_tokens, score_, base, n_known, rows = score_texts(t, model, levels)
                part = b.slice(lo, hi - lo)
                rid = part.column("rid")
                # a row's own key is even, so it meets no word
                key = pa.array(mix64(rid.to_numpy().view(np.uint64)).view(np.int64) & -2)
                yield pa.RecordBatch.from_arrays(
                    [rid, key, pa.nulls(hi - lo, pa.int64()), part.column("doc_id"), part.column("held_out"), pa.array(n_tokens.astype(np.int64)),
                     pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score_)], names)
                if rows is not None:
                    (d, k, c), none = rows, len(rows[0])
                    yield pa.RecordBatch.from_arrays(
                        [rid.take(pa.array(d)), pa.array(k.view(np.int64)), pa.array(c),
                         pa.nulls(none, part.column("doc_id").type), pa.nulls(none, pa.bool_()), pa.nulls(none, pa.int64()),
                         pa.nulls(none, pa.int64()), pa.nulls(none, pa.float64()), pa.nulls(none, pa.float64())], names)

    names = ["rid", "key", "m", "doc_id", "held_out", "n_tokens", "known", "base", "score"]
    d = docs.select("doc_id", "text", "held_out").withColumn("rid", F.monotonically_increasing_id())
    rows = d.mapInArrow(run, f"rid long, key long, m long, doc_id {doc_type}, held_out boolean, n_tokens long, known long, base double, score double")
    if model["more"]:  # words beyond the broadcast ones
        rows = rows.join(words, "key", "left")
    else:
        rows = rows.withColumn("c", F.lit(None).cast("long"))
    n_all = float(np.log10(model["n"] + model["v"] + 1))
    g = rows.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.max("known").alias("known"), F.max("base").alias("base"), F.max("score").alias("score"),
        F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("m"))), F.lit(0)).alias("more"),
        F.coalesce(F.sum(F.col("m") * F.log10(F.col("c") + 1.0)), F.lit(0.0)).alias("rest"))
    return g.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"),
                    F.lit(model["n"]).cast("long").alias("train_tokens"),
                    (F.col("base") + F.col("rest") - F.col("n_tokens") * n_all).alias("base_score"), "score")
