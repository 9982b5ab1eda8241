"""Operator 6: language identification by a bidirectional gated recurrent network.

A text's bytes are cut into windows; in each window one gated recurrent unit
reads forwards and one backwards, every position gets a probability per
language from both states, and a document's probability is the mean over all its
positions. The network is trained in numpy by backpropagation through time on a
bounded sample of windows of labelled documents.

Defined results: ``und`` with score 0 for a null text or one without a letter,
or if nothing could be learned (no labelled document). Every byte of every text is read; the
result depends on the text alone, so equal rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.common import release_memory

#: Bytes of a window, units per direction.
WINDOW, UNITS = 64, 12
#: The labelled sample: about so many documents of each language, so many
#: windows of each document, at most so many windows of a language.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, MAX_WINDOWS = 600, 3, 1500
EPOCHS, BATCH, RATE = 8, 100, 0.01
#: Languages a model can have; the label column is not free text.
MAX_LANGUAGES = 500


def windows(raw: bytes) -> np.ndarray:
    """Rows of WINDOW byte numbers; 256 fills the last row."""
    n = max(1, -(-len(raw) // WINDOW))
    x = np.full(n * WINDOW, 256, np.int16)
    x[: len(raw)] = np.frombuffer(raw, np.uint8)
    return x.reshape(n, WINDOW)


def _start(classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p["E" + d] = rng.normal(0, 0.4, (257, 3 * UNITS))
        p["U" + d] = rng.normal(0, 0.6 / np.sqrt(UNITS), (UNITS, 3 * UNITS))
        p["O" + d] = rng.normal(0, 0.3, (UNITS, classes))
    p["o"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _states(x: np.ndarray, E: np.ndarray, U: np.ndarray, keep: bool):
    """States of one direction for windows as (position, window); with keep, what the way back needs."""
    h = np.zeros((x.shape[1], UNITS), np.float32)
    out = np.empty((x.shape[0], x.shape[1], UNITS), np.float32)
    tape = []
    for t in range(x.shape[0]):
        g = E[x[t]]
        a = h @ U
        zr = g[:, : 2 * UNITS]
        zr += a[:, : 2 * UNITS]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :UNITS], zr[:, UNITS:]
        c = a[:, 2 * UNITS:] * r
        c += g[:, 2 * UNITS:]
        np.tanh(c, out=c)
        if keep:
            tape.append((h, z, r, c, a[:, 2 * UNITS:]))
        h = (h - c) * z
        h += c
        out[t] = h
    return out, tape


def _back(x, tape, d_out, U):
    """Gradients of E and U from the gradients of all states."""
    dE, dU = np.zeros((257, 3 * UNITS), np.float32), np.zeros_like(U)
    dh = np.zeros_like(d_out[0])
    for t in range(len(tape) - 1, -1, -1):
        h, z, r, c, a = tape[t]
        dh = dh + d_out[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * a * r * (1 - r)
        da = np.concatenate([dz, dr, dc * r], 1)
        np.add.at(dE, x[t], np.concatenate([dz, dr, dc], 1))
        dU += h.T @ da
        dh = dh * z + da @ U.T
    return dE, dU


def position_probabilities(x: np.ndarray, p: dict, keep: bool = False):
    """Probabilities (position, window, language) of windows given as rows."""
    xt = np.ascontiguousarray(x.T)
    hf, tf = _states(xt, p["Ef"], p["Uf"], keep)
    hb, tb = _states(xt[::-1], p["Eb"], p["Ub"], keep)
    n = xt.shape[0] * xt.shape[1]
    y = hf.reshape(n, UNITS) @ p["Of"]
    y += np.ascontiguousarray(hb[::-1]).reshape(n, UNITS) @ p["Ob"]
    y += p["o"]
    y -= y.max(1, keepdims=True)
    np.exp(y, out=y)
    y /= y.sum(1, keepdims=True)
    y = y.reshape(xt.shape[0], xt.shape[1], -1)
    return (y, hf, hb, tf, tb, xt) if keep else y


def gradients(x: np.ndarray, label: np.ndarray, p: dict) -> dict[str, np.ndarray]:
    """Gradients of the mean cross entropy of all positions, by backpropagation through time."""
    y, hf, hb, tf, tb, xt = position_probabilities(x, p, True)
    real = (xt < 256)[:, :, None].astype(np.float32)
    y[:, np.arange(len(x)), label] -= 1
    d = y * real / max(1.0, real.sum())
    db = d[::-1]
    g = {"o": d.sum((0, 1)), "Of": np.tensordot(hf, d, ([0, 1], [0, 1])), "Ob": np.tensordot(hb, db, ([0, 1], [0, 1]))}
    g["Ef"], g["Uf"] = _back(xt, tf, d @ p["Of"].T, p["Uf"])
    g["Eb"], g["Ub"] = _back(xt[::-1], tb, db @ p["Ob"].T, p["Ub"])
    return g


def train(x: np.ndarray, label: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = 5) -> dict:
    """Adam on the mean cross entropy of all positions."""
    p = _start(classes, seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    rng = np.random.default_rng(seed)
    step, steps = 0, epochs * -(-len(x) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at: at + BATCH]
            g = gradients(x[pick], label[pick], p)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for k, v in g.items():
                v = v * min(1.0, 1.0 / (norm + 1e-9))
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                p[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def fit(labelled: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, seed: int = 5) -> dict:
    """A model from ``labelled`` (doc_id, text, lang): about ``sample_documents``
    documents a language by key hash, random windows of their whole texts."""
    d = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {"langs": [], "net": {}}
    langs = sorted(counts)
    part = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, sample_documents / n))])
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    picked = d.filter(u < part[F.col("lang")])

    def cut(batches):
        for b in batches:
            rows = []
            for i, text, lang in zip(b["doc_id"], b["text"], b["lang"]):
                w = windows(text.encode("utf-8", "surrogatepass"))
                rng = np.random.default_rng([seed, 0 if pd.isna(i) else int(i) & (2**62 - 1)])
                rows += [(lang, x.tobytes()) for x in w[rng.permutation(len(w))[:SAMPLE_WINDOWS]]]
            yield pd.DataFrame(rows, columns=["lang", "x"])

    few = Window.partitionBy("lang").orderBy(F.xxhash64("x"), "x")
    rows = (picked.mapInPandas(cut, "lang string, x binary").withColumn("r", F.row_number().over(few))
            .filter(F.col("r") <= MAX_WINDOWS).orderBy("lang", "r").collect())
    x = np.stack([np.frombuffer(r["x"], np.int16) for r in rows])
    y = np.array([langs.index(r["lang"]) for r in rows])
    return {"langs": langs, "net": train(x, y, len(langs), seed=seed)}


def _add_direction(x: np.ndarray, E: np.ndarray, U: np.ndarray, O: np.ndarray, y: np.ndarray, order) -> None:
    """Adds one direction's outputs to ``y`` (position, language, window), positions in ``order``."""
    n, k = x.shape[1], 2 * UNITS
    UT, OT = np.ascontiguousarray(U.T), np.ascontiguousarray(O.T)
    h, rows = np.zeros((UNITS, n), np.float32), np.empty((n, 3 * UNITS), np.float32)
    g, a, out = np.empty((3 * UNITS, n), np.float32), np.empty((3 * UNITS, n), np.float32), np.empty(y.shape[1:], np.float32)
    zr, c = g[:k], a[k:]
    z, r = g[:UNITS], g[UNITS:k]
    for t in order:
        np.take(E, x[t], axis=0, out=rows, mode="clip")
        np.copyto(g, rows.T)
        np.matmul(UT, h, out=a)
        zr += a[:k]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        c *= r
        c += g[k:]
        np.tanh(c, out=c)
        h -= c
        h *= z
        h += c
        np.matmul(OT, h, out=out)
        y[t] += out


def window_sums(x: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """The sums of ``position_probabilities`` over each window's real positions, and how
    many these are. The same arithmetic with windows side by side in memory: a step
    runs along all windows instead of along the few units of each."""
    xt = np.ascontiguousarray(x.T, np.intp)
    y = np.zeros((xt.shape[0], len(p["o"]), xt.shape[1]), np.float32)
    _add_direction(xt, p["Ef"], p["Uf"], p["Of"], y, range(len(xt)))
    _add_direction(xt, p["Eb"], p["Ub"], p["Ob"], y, range(len(xt) - 1, -1, -1))
    y += p["o"][:, None]
    y -= y.max(1, keepdims=True)
    np.exp(y, out=y)
    y /= y.sum(1, keepdims=True)
    real = xt < 256
    y *= real[:, None, :]
    return y.sum(0).T, real.sum(0)


def document_probabilities(texts: list[str], net: dict, classes: int, step: int = 1024) -> np.ndarray:
    """Mean position probabilities per text, ``step`` windows at a time."""
    sums, sizes = np.zeros((len(texts), classes)), np.zeros(len(texts))

    def flush(parts, owners):
        x = np.concatenate(parts)
        for at in range(0, len(x), step):
            y, real = window_sums(x[at: at + step], net)
            o = owners[at: at + step]
            np.add.at(sums, o, y)
            np.add.at(sizes, o, real)

    parts, owners, n = [], [], 0
    for i, t in enumerate(texts):
        w = windows(t.encode("utf-8", "surrogatepass"))
        parts.append(w)
        owners.append(np.full(len(w), i))
        n += len(w)
        if n >= 16 * step or i == len(texts) - 1:
            flush(parts, np.concatenate(owners))
            parts, owners, n = [], [], 0
    return sums / np.maximum(sizes, 1)[:, None]


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of the same name."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in kept])  # one struct, so that no names clash
    if not model["langs"]:
        return docs.select(*[f"`{c}`" for c in kept], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size per language

    @F.pandas_udf("struct<lang:string,score:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        p = document_probabilities([t or "" for t in texts], m["net"], len(m["langs"]))
        best = p.argmax(1)
        release_memory()
        return pd.DataFrame({"lang": [m["langs"][k] for k in best], "score": np.clip(p[np.arange(len(p)), best], 0, 1)})

    # declared not deterministic, so that the optimiser neither repeats the network nor moves a filter on its result below it
    once = run.asNondeterministic()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    d = docs.select(row.alias("row"), letters.alias("letters"), once(F.col("text")).alias("p"))
    return d.select("row.*", F.when(F.col("letters"), F.col("p.lang")).otherwise("und").alias("lang_pred"),
                    F.when(F.col("letters"), F.col("p.score")).otherwise(0.0).alias("score"))
