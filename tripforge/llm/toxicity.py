"""Operator 8: toxicity scores behind noisy-channel deobfuscation.

Disguised words (letters swapped for digits or signs, letters spaced out,
letters repeated) are restored before scoring. Each disguised token spans a
lattice: a sign may be one of the letters it looks like or nothing, a repeated
letter may be one letter. A Viterbi pass picks the most likely spelling under a
character trigram model and the channel's costs. A token that is no known word is
also cut into known words, over the same signs: several words spaced out in one
run, joined by signs or written without blanks. Tokens may have any length; the
channel says a letter or digit at most twice and a sign at most three times in a
row, so of a longer run only so many are decoded, as repetitions.
Restored texts are scored by
the toxic words they hold; the words, their weights, the curve over them and the
character model are counted over all labelled rows, in which near copies count as
one. Only the model has a size: KNOWN_WORDS, KNOWN_LETTERS and TRIGRAMS.

Defined results: a null or empty text holds no word and gets the score of no
evidence; without labelled rows of both classes every score is 0. The score
depends on the text alone; texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import mix64, pieces, place_factors, released, stored, word_hashes
from tripforge.llm.components import components

#: Size of the model: words that disguised tokens are cut into (the most frequent of
#: either class; of those equally frequent at the limit none stays), their letters,
#: and character trigrams (the heaviest).
KNOWN_WORDS, KNOWN_LETTERS, TRIGRAMS = 200_000, 100, 300_000
#: Bits of the map of labelled ids.
MARKS = 1 << 26
#: Trigram weights are summed as whole numbers of this part, evidence is counted to this many decimals.
PART, DECIMALS = float(1 << 30), 5
#: Words learned as toxic need this share of toxic documents among those that
#: hold them (lower confidence bound) and this many toxic documents.
LEAST_PRECISION, LEAST_SUPPORT = 0.7, 4
#: Summed weights count up to this much, so that one sure word is enough.
MOST_EVIDENCE = 5.0
PREDICT_FROM = 0.7

#: Letters that a sign may stand for in disguised words; other signs stand for nothing.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "*": "aeiou",
}
#: Channel costs (natural log) of a swap, of a sign (digits excepted) that stands for nothing and of a letter said again.
SWAP, DROP, REPEAT = -0.7, -2.0, -0.7
#: Costs, when a token is cut into words, of a letter or digit outside words and of a sign between them.
OUTSIDE, BETWEEN = -12.0, -0.5
#: Longest token that a worker remembers.
LONGEST = 40

_LETTERS = re.compile(r"[^\W\d_]+")
# runs of signs or of digits before a letter, and of both at a token's end: a run is
# tried once, from its start and as a whole, so a long line of signs takes linear time
# (the character stands before the look behind it, which lets the search skip others)
_INNER_SIGNS = re.compile(r"[^\w\s](?<![^\w\s]{2})[^\w\s]*+(?=[^\W\d_])")
_INNER_DIGITS = re.compile(r"[0-9_](?<![0-9_]{2})[0-9_]*+(?=[^\W\d_])")
_LAST = re.compile(r"[0-9@$!|+(<#*](?<=[^\W\d_].)[0-9@$!|+(<#*]*+(?=[^\w\s]*+(?!\S))")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
#: Three or more single characters that stand apart.
_SPACED = re.compile(r"(?<!\S)(?:[^\s\d.,;:]|[0-9])(?:[ .\-_*][^\s.,;:]){2,}(?=[\s.,;:!?]|$)")
_BLANK = re.compile(r"\s")
#: Disguised tokens remembered by a worker; when full, the memory starts anew.
MEMO = 100_000


def trigrams(word: str) -> list[str]:
    s = f"^^{word}$"
    return [s[i - 2: i + 1] for i in range(2, len(s))]


class Spelling:
    """Character trigram model over word types, and the Viterbi decoder. ``grams``, the
    weights of trigrams and of their first two characters, and ``total``, the number
    of words, are counted from ``counts`` if not given."""

    def __init__(self, counts: dict[str, int], grams: tuple[dict[str, float], dict[str, float]] | None = None, total: int | None = None):
        if grams is None:
            tri, bi = defaultdict(float), defaultdict(float)
            for w, n in counts.items():
                for g in trigrams(w):
                    tri[g] += math.log1p(n)
                    bi[g[:2]] += math.log1p(n)
            grams = dict(tri), dict(bi)
        self.tri, self.bi = grams
        self.memo: dict[str, list[str]] = {}
        total = max(1, sum(counts.values()) if total is None else total)
        self.known: dict[str, float | None] = {}  # words with their log probability, beginnings of words with None
        for w, n in counts.items():
            for i in range(1, len(w)):
                self.known.setdefault(w[:i], None)
            self.known[w] = math.log(n / total)
        self.longest = max(map(len, counts), default=0)

    def step(self, history: str, c: str) -> float:
        return math.log((self.tri.get(history + c, 0.0) + 0.02) / (self.bi.get(history, 0.0) + 0.8))

    @staticmethod
    def signs(token: str) -> list[tuple[str, bool]]:
        """The token's signs; one with True may be left out, as a letter said again."""
        out = []
        for m in re.finditer(r"(.)\1*", token, re.S):
            c, n = m.group(1), len(m.group())
            # a letter or digit said three times or more is one or two letters; a long line of a sign says no more than three
            most = 2 if c.isalnum() else 3
            out += [(c, k == 0 and n > 2 and c.isalnum()) for k in range(min(n, most))]
        return out

    def restore(self, token: str) -> str:
        """The most likely spelling of one disguised token as one word."""
        paths = {"^^": (0.0, None)}  # a word is (the word before, its last letter)
        for c, again in self.signs(token):
            after: dict[str, tuple[float, tuple | None]] = {}

            def offer(history, score, word):
                if history not in after or score > after[history][0]:
                    after[history] = (score, word)

            for history, (score, word) in paths.items():
                if again:
                    offer(history, score + REPEAT, word)
                if c.isalpha():
                    offer(history[1] + c, score + self.step(history, c), (word, c))
                    continue
                for x in LOOKS_LIKE.get(c, ""):
                    offer(history[1] + x, score + SWAP + self.step(history, x), (word, x))
                if not c.isdigit():
                    offer(history, score + DROP, word)
            paths = after or paths
        word = max((score + self.step(history, "$"), history, word) for history, (score, word) in paths.items())[2]
        letters = []
        while word:
            word, x = word
            letters.append(x)
        return "".join(reversed(letters))

    def split(self, token: str) -> list[str]:
        """The known words of the most likely cut of a disguised token."""
        signs = self.signs(token)
        best, back = [0.0] + [-math.inf] * len(signs), [(0, "")] * (len(signs) + 1)
        for i, (c, again) in enumerate(signs):
            outside = REPEAT if again else OUTSIDE if c.isalnum() else BETWEEN
            if best[i] + outside > best[i + 1]:
                best[i + 1], back[i + 1] = best[i] + outside, (i, "")
            paths, alone = {"": 0.0}, 0.0
            for j in range(i, len(signs)):
                c, again = signs[j]
                alone += REPEAT if again else OUTSIDE if c.isalnum() else BETWEEN
                after: dict[str, float] = {}
                for start, score in paths.items():
                    for x in c if c.isalpha() else LOOKS_LIKE.get(c, ""):
                        if start + x in self.known:
                            after[start + x] = max(after.get(start + x, -math.inf), score + (0.0 if c.isalpha() else SWAP))
                    if start and (again or not c.isalnum()):
                        after[start] = max(after.get(start, -math.inf), score + (REPEAT if again else DROP))
                # a start that no ending can bring above no word at all is dropped
                paths = {w: v for w, v in after.items() if v > alone + OUTSIDE * (self.longest - len(w))}
                if not paths:
                    break
                for w, v in paths.items():
                    if self.known[w] is not None and best[i] + v + self.known[w] > best[j + 1]:
                        best[j + 1], back[j + 1] = best[i] + v + self.known[w], (i, w)
        out, at = [], len(signs)
        while at:
            at, w = back[at]
            out.append(w)
        return [w for w in out if w]

    def read(self, token: str) -> list[str]:
        """The words of one disguised token."""
        if token in self.memo:
            return self.memo[token]
        found = [self.restore(token)]
        if self.known.get(found[0]) is None:
            found += self.split(token)
        if len(token) <= LONGEST:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[token] = found
        return found


def disguised(text: str):
    """Disguised tokens of a lower-cased text, spaces between single characters removed."""
    for pattern in (_INNER_SIGNS, _INNER_DIGITS, _LAST, _REPEATED):
        hi = 0
        for m in pattern.finditer(text):
            lo = m.start()
            if lo < hi:  # of the same token
                continue
            while lo and not text[lo - 1].isspace():
                lo -= 1
            blank = _BLANK.search(text, m.start())
            hi = blank.start() if blank else len(text)
            t = text[lo:hi].strip(".,;:%&\"'()")
            if t:
                yield t
    for m in _SPACED.finditer(text):
        yield re.sub(r"[ .\-_*]", "", m.group())


def words(text: str, spelling: Spelling | None) -> set[str]:
    """The words of the restored text."""
    text = text.lower()
    out = set(_LETTERS.findall(text))
    if spelling is not None:
        out.update(w for t in set(disguised(text)) for w in spelling.read(t))
    return out


# ---------------------------------------------------------------- learning
def copy_keys(text: str) -> list[int]:
    """Four least five-word hashes of a text; texts that share one are near copies."""
    h, _ = word_hashes([text])
    s = h[:1] if len(h) < 5 else sum(h[k: len(h) - 4 + k] * f for k, f in enumerate(place_factors(5)))
    if not len(s):
        return []
    return [int(mix64(s ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)).min().view(np.int64)) for seed in range(4)]


def copy_weights(texts: list[str]) -> np.ndarray:
    """1 / size of each text's group; texts that share one of four least five-word hashes form a group."""
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple, int] = {}
    for i, t in enumerate(texts):
        for key in enumerate(copy_keys(t)):
            parent[root(i)] = root(first.setdefault(key, i))
    sizes = Counter(root(i) for i in range(len(texts)))
    return np.array([1.0 / sizes[root(i)] for i in range(len(texts))])


def marks_toxic(t, c, share: list[float], sqrt):
    """Whether a word held by weights ``t`` of toxic and ``c`` of other texts is learned
    as toxic, and its odds; numbers or columns."""
    prior = share[1] / (share[0] + share[1])
    a = t * (1.0 if prior >= 0.5 else share[0] / share[1])  # precision at even classes
    b = c * (1.0 if prior < 0.5 else share[1] / share[0])
    n, p, z = t + c, a / (a + b), 1.96
    low = (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return (t >= LEAST_SUPPORT) & (low >= LEAST_PRECISION) & (t / n >= LEAST_PRECISION), (a + 0.5) / (b + 0.5)


def curve(weight: np.ndarray, y: np.ndarray, evidence: np.ndarray) -> tuple[float, float]:
    """Base and slope of the logistic curve over the evidence."""
    slope, base = 0.1, 0.0
    for _ in range(50):  # Newton steps, weighted, lightly damped
        p = 1 / (1 + np.exp(-np.clip(base + slope * evidence, -30, 30)))
        r = weight * p * (1 - p)
        g = np.array([(weight * (y - p)).sum(), (weight * (y - p) * evidence).sum() - 0.1 * slope])
        H = np.array([[r.sum() + 1e-3, (r * evidence).sum()], [(r * evidence).sum(), (r * evidence**2).sum() + 0.1]])
        d = np.clip(np.linalg.solve(H, g), -1, 1)
        base, slope = base + d[0], slope + d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(base), float(slope)


def evidence_of(weights) -> float:
    return min(MOST_EVIDENCE, math.fsum(sorted(weights)))


def learn(texts: list[str], labels: list[int]) -> dict:
    """Words that mark toxic texts, and a logistic curve over their summed weights; the plain form of ``fit`` for a few texts."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return {}
    weight = copy_weights(texts)
    counts: Counter = Counter()
    for t in texts:
        counts.update(_LETTERS.findall(t.lower()))
    spelling = Spelling(counts)
    sets = [words(t, spelling) for t in texts]
    hold = defaultdict(lambda: [0.0, 0.0])
    for s, k, v in zip(sets, y, weight):
        for w in s:
            hold[w][k] += v
    share = [max(weight[y == k].sum(), 1e-9) for k in (0, 1)]
    lexicon = {}
    for w, (c, t) in hold.items():
        marks, odds = marks_toxic(t, c, share, math.sqrt)
        if marks:
            lexicon[w] = math.log(odds)
    evidence = np.array([evidence_of(lexicon[w] for w in s if w in lexicon) for s in sets])
    base, slope = curve(weight, y, evidence)
    return {"spelling": spelling, "lexicon": lexicon, "base": base, "slope": slope}


def text_score(text: str | None, model: dict) -> float:
    if not model:
        return 0.0
    lexicon = model["lexicon"]
    found = words(text, model["spelling"]) if text else ()
    evidence = evidence_of(lexicon[w] for w in found if w in lexicon)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model["base"] + model["slope"] * evidence))))


# -------------------------------------------------------------- Spark side
def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([v for r in rows for v in r], kind))


def _texts(docs: DataFrame, lab: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash), text of all rows whose doc_id is in ``lab`` and of few
    others, so that joins move labelled texts alone: ids are looked up by hash in a bitmap
    of MARKS bits. More labels than that let more rows through, never fewer."""
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    bits = lab.select(mark.alias("m")).groupBy(F.shiftright("m", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(m % 64 as int)))").alias("bits"))
    rows = docs.filter("text is not null and doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"), "text", mark.alias("m"))
    rows = rows.join(F.broadcast(bits), F.shiftright("m", 6) == F.col("w"))
    return rows.filter(F.getbit("bits", F.expr("cast(m % 64 as int)")) == 1).select("doc_id", "h", "text")


def _sizes(texts: DataFrame, lab: DataFrame) -> DataFrame:
    """doc_id, toxic, size of its group of near copies (as in ``copy_weights``) of every
    labelled text; of several texts of a doc_id the one with the least hash counts."""

    def run(batches):
        for b in batches:
            for part in pieces(b):
                keys = [copy_keys(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), _lists(keys, pa.int64())], ["doc_id", "h", "keys"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    one = texts.mapInArrow(released(run), f"doc_id {kind}, h long, keys array<long>").groupBy("doc_id").agg(F.min_by("keys", "h").alias("keys"))
    one = stored(one.join(lab, "doc_id"), "toxicity-keys")
    keys = one.select("doc_id", F.posexplode("keys").alias("place", "key"))
    first = keys.groupBy("place", "key").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    of = stored(components(keys.join(first, ["place", "key"]).select(F.col("doc_id").alias("a"), "b")), "toxicity-copies")
    size = of.join(of.groupBy("component").agg(F.count("*").alias("size")), "component").select(F.col("node").alias("doc_id"), "size")
    return stored(one.drop("keys").join(size, "doc_id", "left").fillna(1, "size"), "toxicity-sizes")


def _read(texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """The columns of ``sizes`` with words and how often each and the disguised tokens of every labelled text."""
    one = texts.join(sizes, "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("toxic", "size", "text"), "h").alias("r")).select("doc_id", "r.*")

    def run(batches):
        for b in batches:
            for part in pieces(b):
                low = [t.lower() for t in part.column("text").to_pylist()]
                counts = [Counter(_LETTERS.findall(t)) for t in low]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), part.column("size"), _lists(counts, pa.string()),
                     _lists([c.values() for c in counts], pa.int32()), _lists([set(disguised(t)) for t in low], pa.string())],
                    ["doc_id", "toxic", "size", "words", "times", "tokens"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return stored(one.mapInArrow(released(run), f"doc_id {kind}, toxic int, size long, words array<string>, times array<int>, tokens array<string>"), "toxicity-read")


def _spelling(read: DataFrame) -> Spelling:
    """The spelling model of all words of ``read``."""
    each = read.select("toxic", F.explode(F.arrays_zip("words", "times")).alias("w"))
    by_class = [F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("w.times").cast("long"))), F.lit(0)).alias(f"n{k}") for k in (0, 1)]
    counts = stored(each.groupBy(F.col("w.words").alias("word")).agg(*by_class), "toxicity-words").withColumn("n", F.expr("n0 + n1"))
    total, *of = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "n0", "n1")]).first()

    # words as frequent in one class, were the class as large as both, as the limit allows
    rate = F.greatest(*[F.floor(F.col(f"n{k}") * (total / max(1, of[k]))) for k in (0, 1)])
    short = counts.filter(F.length("word") <= KNOWN_LETTERS).select("word", "n", rate.alias("rate"))
    stay, least = 0, 0
    for r in short.groupBy("rate").agg(F.count("*").alias("n")).orderBy(F.desc("rate")).toLocalIterator():
        stay += r["n"]
        if stay > KNOWN_WORDS:
            least = r["rate"] + 1
            break
    known = {r["word"]: r["n"] for r in short.filter(F.col("rate") >= least).collect()}

    def grams(batches):
        for b in batches:
            found: Counter = Counter()
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                v = round(math.log1p(n) * PART)
                for g in trigrams(w):
                    found[g] += v
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], ["gram", "v"])

    tri = stored(counts.select("word", "n").mapInArrow(grams, "gram string, v long").groupBy("gram").agg(F.sum("v").alias("v")), "toxicity-grams")
    tri = tri.withColumn("history", F.substring("gram", 1, 2))
    heavy = tri.orderBy(F.desc("v"), "gram").limit(TRIGRAMS)
    rows = heavy.join(tri.groupBy("history").agg(F.sum("v").alias("b")), "history").select("gram", "v", "b").collect()
    return Spelling(known, ({r["gram"]: r["v"] / PART for r in rows}, {r["gram"][:2]: r["b"] / PART for r in rows}), total)


def _weights(counted: DataFrame, *by: str) -> DataFrame:
    """Sums of 1 / size by ``by``, added in order so that they are the same on every run."""
    parts = counted.groupBy(*by, "size").agg(F.count("*").alias("n"))
    parts = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.col("n") / F.col("size"))).alias("v"))
    return parts.withColumn("v", F.aggregate("v", F.lit(0.0), lambda a, x: a + x))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Learn from all labelled documents: ``learn`` as aggregations. The driver gets the
    model and, for the curve, weights by evidence."""
    lab = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    lab = lab.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = _texts(docs, lab)
    sizes = _sizes(texts, lab)
    of = {r["toxic"]: r["v"] for r in _weights(sizes, "toxic").collect()}
    if len(of) < 2:
        return {}
    share = [max(of[k], 1e-9) for k in (0, 1)]
    read = _read(texts, sizes)
    spelling = _spelling(read)
    shared = docs.sparkSession.sparkContext.broadcast(spelling)  # KNOWN_WORDS, KNOWN_LETTERS and TRIGRAMS bound it

    def restore(batches):
        for b in batches:
            more = [{w for t in tokens for w in shared.value.read(t)}.difference(own)
                    for own, tokens in zip(b.column("words").to_pylist(), b.column("tokens").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), b.column("size"), _lists(more, pa.string())],
                                             ["doc_id", "toxic", "size", "words"])

    own = read.select("doc_id", "toxic", "size", "words")
    more = stored(read.filter(F.size("tokens") > 0).select("doc_id", "toxic", "size", "words", "tokens")
                  .mapInArrow(released(restore), own.schema), "toxicity-restored")
    held = own.unionByName(more)
    words_of = _weights(held.select("toxic", "size", F.explode("words").alias("word")), "word", "toxic").groupBy("word").agg(
        *[F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("v"))), F.lit(0.0)).alias(f"v{k}") for k in (0, 1)])
    marks, odds = marks_toxic(F.col("v1"), F.col("v0"), share, F.sqrt)
    lexicon = {r["word"]: math.log(r["odds"]) for r in words_of.filter(marks).select("word", odds.alias("odds")).collect()}
    toxic = docs.sparkSession.sparkContext.broadcast(lexicon)

    def add(batches):
        marked, weight = pa.array(toxic.value, pa.string()), [*toxic.value.values()]
        for b in batches:
            lists = b.column("words")
            at = pc.index_in(lists.flatten(), value_set=marked)
            place = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
            rows: dict[int, list[float]] = defaultdict(list)
            for i, k in zip(np.asarray(pc.list_parent_indices(lists))[place].tolist(), at.take(pa.array(place)).to_pylist()):
                rows[i].append(weight[k])
            evidence = [evidence_of(rows[i]) if i in rows else 0.0 for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), b.column("size"), pa.array(evidence, pa.float64())],
                                             ["doc_id", "toxic", "size", "evidence"])

    kind = read.schema["doc_id"].dataType.simpleString()
    parts = held.mapInArrow(add, f"doc_id {kind}, toxic int, size long, evidence double")  # a text's own words, restored ones
    whole = parts.groupBy("doc_id", "toxic", "size").agg(F.round(F.least(F.sum("evidence"), F.lit(MOST_EVIDENCE)), DECIMALS).alias("evidence"))
    # at most MOST_EVIDENCE * 10 ** DECIMALS steps of two classes
    steps = _weights(whole, "evidence", "toxic").toPandas().sort_values(["evidence", "toxic"])
    base, slope = curve(steps["v"].to_numpy(), steps["toxic"].to_numpy(), steps["evidence"].to_numpy())
    return {"spelling": spelling, "lexicon": lexicon, "base": base, "slope": slope}


def score(docs: DataFrame, model: dict, out: str = "score") -> DataFrame:
    """``docs`` with the probability that ``text`` is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded as in fit, and the toxic words

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([text_score(t, m) for t in texts], dtype="float64")

    return docs.withColumn(out, run(F.col("text")))
