"""Operators 11 to 13 against brute force, the library and exact round trips, with
nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tripforge.llm import importance, middle, queries, sentencepieces

DOCS = "doc_id long, text string, n long, rank string, _id string, _down string, score double"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(4)
    words = ["alpha", "Beta", "straße", "naïve", "x", "one", "two2", "é", "漢字", "\U0001f600", "--", "it's", "▁", "a" * 70]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(160)]
    return out + ["", None, " ", " \n\t ", "one", " one ", "<P>", "a <S> b " * 30, "x<M", "  lead\n", "tail \x0b", "\x85 ", "A\x00B",
                  "word " * 20_000, "-" * 50_000, " " * 5_000]


@pytest.fixture(scope="module")
def rows():
    t = texts()
    made = [(i, x, 7, "own", "i", "d", 0.5) for i, x in enumerate(t)]
    return made + [made[3], made[3], (3, "another text of id three " * 9, 7, "own", "i", "d", 0.5), (None, "no id " * 30, 7, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- importance
def word_list(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, longest):
    w = word_list(text)
    return [" ".join(w[i: i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_draw(rows, target, longest, percent, least):
    """(doc_id, n_features, weight, score, rank) rows by the contract, in plain Python."""
    def bucket(f):
        return zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text, longest)))
    for text in target:
        t.update(map(bucket, features(text, longest)))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        f = features(text, longest)
        g = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in map(bucket, f)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(word_list(text)) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = Counter()
    drawn = []
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        drawn.append((*r[:4], k + 1))
        ranks[tuple(r)] += 1
    for r in out:
        if ranks[tuple(r)]:
            ranks[tuple(r)] -= 1
        else:
            drawn.append((*r[:4], None))
    return Counter(drawn)


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (2, 35, 5), (3, 100, 0), (1, 0, 20)])
def test_resample_equals_brute_force(spark, docs, rows, longest, percent, least):
    target = ["one two2 straße", None, "", "alpha it's one", "unseen words"]
    d = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, percent=percent, least_words=least)
    assert d.columns[:2] == ["doc_id", "text"] and {"n", "_id", "_down"} < set(d.columns)
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in d.collect())
    assert got == brute_draw([(r[0], r[1]) for r in rows], target, longest, percent, least)


def test_resample_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(empty, none).count() == 0
    d = importance.resample(docs, none)
    assert d.count() == docs.count() and d.filter("rank is not null").count() > 0


def test_cutoff_is_the_kth_key(spark, tmp_path):
    """Ties, a key that holds a third of the rows, negative keys, empty partitions, every k near the edges."""
    rng = random.Random(3)
    keys = [(rng.randint(-50, 50), 0, rng.randint(0, 9), rng.randint(0, 3)) for _ in range(2000)] + [(-7, 0, 4, 1)] * 1000
    spark.createDataFrame(keys, "down long, last long, id long, features long").repartition(7).write.parquet(str(tmp_path / "keys"))
    stored = spark.read.parquet(str(tmp_path / "keys"))
    inside = sorted(keys)
    for k in (1, 2, 999, 1500, 1501, 2999, 3000):
        assert importance.cutoff(stored, k) == inside[k - 1]
    assert importance.cutoff(stored, 0) is None
    with pytest.raises(ValueError):
        importance.cutoff(stored, 3001)


def test_every_round_discards_a_quarter():
    """The weighted median of partition medians leaves at most three quarters on either side."""
    rng = random.Random(9)
    for _ in range(200):
        parts = [sorted((rng.randint(0, 30),) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 9))]
        pivot = importance.weighted_median([(p[(len(p) - 1) // 2], len(p)) for p in parts])
        whole = [x for p in parts for x in p]
        assert sum(x < pivot for x in whole) <= 0.75 * len(whole) + len(parts)
        assert sum(x > pivot for x in whole) <= 0.75 * len(whole)


# -------------------------------------------------------------------- middle
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(doc_id, text, fim, spm):
    t = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k: k + 8], 16) for k in (0, 8, 16, 24))
    u = UNIT.findall(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return len(u), "plain", None, None, t
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("fim,spm", [(50, 80), (100, 0), (100, 100)])
def test_middle_equals_brute_force(docs, rows, fim, spm):
    d = middle.restore(middle.transform(docs, fim_percent=fim, spm_percent=spm))
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"], r["rank"]) for r in d.collect())
    assert got == Counter((r[0], *brute_middle(r[0], r[1], fim, spm), r[1] or "", r[3]) for r in rows)


def test_middle_of_an_empty_table(empty):
    assert middle.restore(middle.transform(empty)).count() == 0
    with pytest.raises(ValueError):
        middle.transform(empty, output="n")


def test_rotation_and_its_inverse():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(0, 40))
        raw = bytes(rng.integers(97, 123, n, dtype=np.uint8))
        a, b = sorted(int(x) for x in rng.integers(0, n + 1, 2))
        buf = bytearray(raw)
        middle.rotate(buf, a, b, n)
        assert bytes(buf) == raw[:a] + raw[b:] + raw[a:b]
        for form in ("psm", "spm"):
            assert middle.restore_bytes(middle.transform_bytes(raw, a, b, form), form) == raw
    with pytest.raises(ValueError):
        middle.restore_bytes(b"no sentinel", "psm")


# ------------------------------------------------------------- sentencepieces
@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(docs, rows, library):
    d = sentencepieces.decode(sentencepieces.encode(docs, MODEL, ids="n"), MODEL, ids="n", out="rank")
    want = [(r[0], r[1], tuple(library.encode(r[1] or "")), library.decode(library.encode(r[1] or ""))) for r in rows]
    assert Counter((r["doc_id"], r["text"], tuple(r["n"]), r["rank"]) for r in d.collect()) == Counter(want)
    digest = Counter(tuple(r) for r in sentencepieces.digests(docs, MODEL).collect())
    assert digest == Counter((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                             for i, _, ids, back in want)


def test_pieces_of_an_empty_table_and_null_ids(spark, empty):
    assert sentencepieces.decode(sentencepieces.encode(empty, MODEL), MODEL).count() == 0
    d = spark.createDataFrame([(1, None), (2, []), (3, [None, 1, 31, 259])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in sentencepieces.decode(d, MODEL).orderBy("doc_id").collect()] == ["", "", "\x1c  "]


def test_random_strings_equal_the_library(library):
    """Characters with and without pieces, repeated pairs, blanks, and a memory that starts anew."""
    rng = random.Random(8)
    alphabets = [list("abeht \n"), list("ab"), list("aA1-_/+= \t"), ["▁", " ", "  ", "th", "e", "é", "漢", "\U0001f600", "\x00"],
                 [chr(c) for c in range(33, 1200)]]
    hard = ["".join(rng.choice(a) for _ in range(rng.randint(0, 120))) for a in alphabets for _ in range(400)]
    hard += [" " * n + x for n in range(70) for x in ("", "\n", "the")] + ["the" * n for n in range(1, 60)]
    coder = sentencepieces.Coder(sentencepieces.read_model(MODEL))
    for lo in range(0, len(hard), 150):
        if lo % 600 == 0:
            coder._forget()
        part = hard[lo: lo + 150]
        ids, bounds = coder.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library.encode(part)
        assert coder.decode(ids, bounds) == library.decode(library.encode(part))
    wild = [[rng.choice([rng.randint(0, 31_999), rng.randint(0, 300)]) for _ in range(rng.randint(0, 12))] for _ in range(500)]
    bounds = np.cumsum([0, *map(len, wild)])
    assert coder.decode(np.array([i for r in wild for i in r]), bounds) == [library.decode(r) for r in wild]


def test_merge_order_where_a_merge_makes_a_better_pair():
    """Simultaneous merges alone would err here: after ``xy`` the better ``xyzw`` takes the next symbols first."""
    names = ["x", "y", "z", "w", "zw", "xy", "xyzw", "xyzwx", "xyz"]
    scores = {"zw": -1.0, "xyzw": -2.0, "xyzwx": -3.0, "xy": -9.0, "xyz": -8.0}
    model = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(n, scores.get(n, -100.0 - k), 1) for k, n in enumerate(names)]
    v = sentencepieces.Vocabulary(model)
    for word in ("xyzw", "xyzwxyzw", "xyxyzwxyzw", "xyxy", "zwxyzxyzw"):
        codes = np.array([ord(c) for c in word], np.int64)
        rounds = sentencepieces.merge_rounds(codes, np.array([0, len(word)]), v)[0].tolist()
        assert rounds == sentencepieces.merge_one_by_one([int(v.symbol[c]) for c in codes], v.merged)


def test_one_megabyte_words_end_soon():
    coder = sentencepieces.Coder(sentencepieces.read_model(MODEL))
    for t in ("a" * (1 << 20), "-" * (1 << 20), "x9" * (1 << 19), "漢字" * (1 << 18), " " * 100_000):
        ids, bounds = coder.encode([t])
        assert coder.decode(ids, bounds) == [t]


def test_queries_on_a_written_table(spark, docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("one two2 straße",)], "text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    n = docs.count()
    got = {name: queries.QUERIES[name](spark, str(tmp_path)) for name in ("op11_importance_resampling", "op12_fill_in_middle", "op13_sentencepiece")}
    assert [d.count() for d in got.values()] == [n, n, n]
    assert got["op11_importance_resampling"].columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got["op12_fill_in_middle"].filter("restored_sha256 is null or (form = 'plain') != (prefix_chars is null)").count() == 0
