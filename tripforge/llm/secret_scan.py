r"""Operator 7: secret scans by grammar inference.

Base rules find three kinds of spans (``assign``, ``access``, ``hex``). Strings
that the rules label in a bounded sample of documents train one probabilistic
automaton per kind: a prefix tree over character classes whose states are merged
while a Hoeffding test finds their counts compatible. Every long run of
credential characters in every text is then scored: log likelihood of its format
under the best automaton against a character model of the runs no rule labels
(long words, numbers). Runs
(of 16 characters or more; shorter ones hold too little to judge a format by)
that score high enough are added whole as kind ``grammar``, also where a base span
covers a part of them; base spans stay. A dotted run is judged whole first, then by
the runs between its dots; of a run that is none, the rest beside base spans is judged.

Defined results: a null text counts as empty; no labelled string in the sample
means no added spans; positions are code points, end exclusive; texts are
scanned whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import release_memory

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
# whole runs, so the least length can stand in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST_RUN = 16
DOTTED = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ("assign", "access", "hex", "grammar")

#: Expected number of documents whose labelled strings train the automata, and
#: the most strings per kind. Everything else reads all documents.
SAMPLE_DOCUMENTS, SAMPLE_STRINGS = 20_000, 400
#: Merging: significance of the compatibility test.
ALPHA = 0.05
#: Ends counted in every state, so that a length never seen is unlikely, not impossible.
END_UNSEEN = 0.05
#: A run is added from this log-likelihood ratio per character and in total.
LEAST_PER_CHARACTER, LEAST_TOTAL = 0.5, 12.0

#: Character classes and the number of characters in each.
CLASSES = (("abcdef", "x"), ("ghijklmnopqrstuvwxyz", "l"), ("ABCDEF", "X"), ("GHIJKLMNOPQRSTUVWXYZ", "L"),
           ("0123456789", "d"), ("+/_.=-", "p"))
CLASS_OF = {c: name for chars, name in CLASSES for c in chars}
CLASS_SIZE = {name: len(chars) for chars, name in CLASSES}
_TO_CLASS = str.maketrans(CLASS_OF)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret) of the base rules."""
    out = []
    if ":" in text or "=" in text:
        out = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    out.sort()
    return out


# ------------------------------------------------------------ the automata
class Automaton:
    """A probabilistic automaton: per state, counts of symbols, ends and next states."""

    def __init__(self, words: list[str]):
        self.moves: list[dict[str, int]] = [{}]
        self.counts: list[dict[str, int]] = [defaultdict(int)]
        self.ends = [0]
        for word in words:
            at = 0
            for c in word:
                self.counts[at][c] += 1
                if c not in self.moves[at]:
                    self.moves[at][c] = len(self.moves)
                    self.moves.append({})
                    self.counts.append(defaultdict(int))
                    self.ends.append(0)
                at = self.moves[at][c]
            self.ends[at] += 1

    def total(self, q: int) -> int:
        return self.ends[q] + sum(self.counts[q].values())

    def compatible(self, a: int, b: int, bound: float) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            na, nb = self.total(a), self.total(b)
            if not na or not nb:
                continue
            far = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.ends[a] / na - self.ends[b] / nb) > far:
                return False
            for c in self.counts[a].keys() | self.counts[b].keys():
                if abs(self.counts[a].get(c, 0) / na - self.counts[b].get(c, 0) / nb) > far:
                    return False
            pairs += [(self.moves[a][c], self.moves[b][c]) for c in self.moves[a].keys() & self.moves[b].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.counts[b].items():
                self.counts[a][c] += n
            for c, q in self.moves[b].items():
                if c in self.moves[a]:
                    pairs.append((self.moves[a][c], q))
                else:
                    self.moves[a][c] = q

    def merge_states(self) -> None:
        """Red states are kept; each frontier state joins the first compatible red one or becomes red."""
        bound = math.sqrt(0.5 * math.log(2 / ALPHA))
        red, seen = [0], {0}
        frontier = [(0, c) for c in sorted(self.moves[0])]
        while frontier:
            parent, c = frontier.pop(0)
            q = self.moves[parent][c]
            if q in seen:
                continue
            host = next((r for r in red if self.compatible(r, q, bound)), None)
            if host is None:
                red.append(q)
                seen.add(q)
                frontier += [(q, s) for s in sorted(self.moves[q])]
            else:
                self.moves[parent][c] = host
                self.fold(host, q)
                frontier += [(r, s) for r in red for s in sorted(self.moves[r]) if self.moves[r][s] not in seen and (r, s) not in frontier]
        kept = {q: i for i, q in enumerate(red)}
        self.moves = [{c: kept[n] for c, n in self.moves[q].items() if n in kept} for q in red]
        self.counts = [dict(self.counts[q]) for q in red]
        self.ends = [self.ends[q] for q in red]

    def scorer(self) -> list[tuple[dict[str, tuple[float, int]], float]]:
        """Per state: by class the log probability of one character of it and the
        next state; and the log probability of ending there, a little even if never seen."""
        out = []
        for q in range(len(self.moves)):
            n = self.total(q) + END_UNSEEN
            steps = {c: (math.log(k / n / CLASS_SIZE[c]), self.moves[q][c]) for c, k in self.counts[q].items() if c in self.moves[q]}
            out.append((steps, math.log((self.ends[q] + END_UNSEEN) / n)))
        return out


def train(strings: dict[str, list[str]], words: list[str]) -> dict:
    """Automata of the labelled ``strings`` by kind, and the model of ordinary ``words``."""
    automata = []
    for kind in KINDS[:3]:
        if strings.get(kind):
            a = Automaton([s.translate(_TO_CLASS) for s in sorted(strings[kind])])
            a.merge_states()
            automata.append(a.scorer())
    pairs, firsts = defaultdict(int), defaultdict(int)
    for w in words:
        for x, y in zip(" " + w, w + " "):
            pairs[x + y] += 1
            firsts[x] += 1
    return {"automata": automata, "pairs": dict(pairs), "firsts": dict(firsts)}


def ratio(run: str, model: dict) -> float:
    """Log likelihood of the whole run, end included, under the best automaton less that of ordinary words."""
    plain = 0.0
    for before, c in zip(" " + run, run + " "):
        plain += math.log((model["pairs"].get(before + c, 0) + 0.1) / (model["firsts"].get(before, 0) + 6.9))
    best = -math.inf
    classes = run.translate(_TO_CLASS)
    for states in model["automata"]:
        at, total = 0, 0.0
        for c in classes:
            step = states[at][0].get(c)
            if step is None:
                break
            total += step[0]
            at = step[1]
        else:
            best = max(best, total + states[at][1])
    return best - plain


def runs_of(text: str):
    """Per run of credential characters: its bounds if it is dotted, else None, and the bounds of the runs without dots."""
    for m in DOTTED.finditer(text):
        s, e = m.span()
        plain = [x.span() for x in CANDIDATE.finditer(text, s, e)]
        run = m.group()
        s, e = s + len(run) - len(run.lstrip(".")), e - len(run) + len(run.rstrip("."))
        yield (s, e) if e - s >= LEAST_RUN and "." in text[s:e] else None, plain


class Base:
    """The base spans of a text by place."""

    def __init__(self, spans: list[tuple[int, int, int, str]]):
        self.spans = spans  # in order of their starts
        self.starts = [x[0] for x in spans]
        self.reach: list[int] = []  # how far the spans up to this one reach
        for x in spans:
            self.reach.append(max(x[2], self.reach[-1] if self.reach else 0))

    def rest(self, s: int, e: int) -> list[tuple[int, int]]:
        """The parts of [s, e) outside the base spans."""
        out = []
        for k in range(bisect_right(self.reach, s), bisect_left(self.starts, e)):
            a, _, b, _ = self.spans[k]
            if s < b:
                if a > s:
                    out.append((s, a))
                s = max(s, b)
        return out + [(s, e)] if s < e else out


def all_spans(text: str, model: dict) -> list[tuple[int, int, int]]:
    base = Base(base_spans(text))
    out = [x[:3] for x in base.spans]
    if model["automata"]:
        def added(s, e):
            """Whether [s, e) is a secret; then it is in ``out``, or base spans cover it."""
            if not base.rest(s, e):
                return True
            r = ratio(text[s:e], model)
            if r < LEAST_TOTAL or r < LEAST_PER_CHARACTER * (e - s):
                return False
            out.append((s, 3, e))
            return True

        for dotted, plain in runs_of(text):
            if dotted and added(*dotted):
                continue
            for s, e in plain:
                if not added(s, e):
                    for a, b in base.rest(s, e):
                        if (a, b) != (s, e) and b - a >= LEAST_RUN:
                            added(a, b)
        out.sort()
    return out


# -------------------------------------------------------------- Spark side
def fit(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> dict:
    """Train on the labelled strings of about ``sample_documents`` documents, chosen by key hash."""
    d = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    n = d.count()
    h = F.xxhash64(F.lit("secrets"), F.col("doc_id").cast("string"))
    if n > sample_documents:
        d = d.filter(h < int(-(2**63) + sample_documents / n * 2**64))

    def strings(batches):
        for b in batches:
            rows = []
            for text in b["text"]:
                base = Base(base_spans(text))
                rows += [(KINDS[k], s) for _, k, _, s in base.spans]
                rows += [("word", text[s:e]) for dotted, plain in runs_of(text) for s, e in ([dotted] if dotted else []) + plain
                         if base.rest(s, e) == [(s, e)]]
            yield pd.DataFrame(rows, columns=["kind", "value"])

    found = d.select("text").mapInPandas(strings, "kind string, value string").distinct()
    from pyspark.sql import Window

    first = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= SAMPLE_STRINGS).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["kind"]].append(r["value"])
    return train(by, sorted(by["word"]))


def scan(docs: DataFrame, model: dict, spans: str = "spans") -> DataFrame:
    """``docs`` with the array of (kind, start, end) of all secrets in ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_STRINGS

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def run(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t or "", m)] for t in texts])

    return docs.withColumn(spans, run(F.col("text")))


def redact(docs: DataFrame, model: dict, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans become one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            at, parts = 0, []
            for s, _, e in all_spans(t, shared.value) if t else ():
                if e > at:
                    parts += [t[at:s], mark] if s >= at else []
                    at = e
            out.append("".join([*parts, t[at:]]) if at else t)
        release_memory()
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", run(F.col("text")))


def digests(docs: DataFrame, model: dict) -> DataFrame:
    d = scan(docs.select("doc_id", "text"), model)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return d.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"] != "grammar")).cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))
