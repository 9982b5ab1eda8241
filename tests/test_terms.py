"""Rule terms in texts by joins, against plain Python over all texts and terms (F2, F3, F4, UD1, X4, X5)."""

import difflib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tripforge import rules
from tripforge.operators import terms as tm
from tripforge.operators.preferences import text_signals, text_terms

LETTERS = "abcde"


def similar(word, term, ratio=rules.FUZZY_RATIO):
    return difflib.SequenceMatcher(None, word, term).ratio() >= ratio


def brute(text, terms, fuzzy, min_len=4):
    low = (text or "").lower()
    tokens = set(re.findall("[a-zA-Z]+", low))
    out = set()
    for t in terms:
        if t in low if " " in t else re.search(rf"\b{re.escape(t)}\b", low):
            out.add(t)
        elif fuzzy and " " not in t and len(t) >= min_len and any(similar(w, t) for w in tokens):
            out.add(t)
    return out


@pytest.mark.parametrize("fuzzy", [False, True])
def test_terms_equal_plain_search(spark, fuzzy):
    rng = random.Random(4)
    listed = tm.all_terms(rules.KEYWORD_WEIGHTS, rules.TEXT_WEATHER_KEYWORDS)
    pool = [w for t in listed for w in t.split()] + ["the", "muzeums", "beachs", "bold", "town,", "hot.", "Old", "TOWN", "sea-side", "sea_side", "plajă", "é", "xold", "townish", "not", "too"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(250)]
    texts += ["", None, "old  town", "old town", "bold towns", "not too\thot", "good weather,good enough", "local food", "xlocal foody", "old", "town old town"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(4)
    got = {r.id: set(r.matched_terms) for r in text_terms(df, "id", "t", fuzzy=fuzzy).collect()}
    assert got == {i: brute(t, listed, fuzzy) for i, t in enumerate(texts)}


def test_long_terms_and_large_tables(spark):
    """Phrases of many words, first words of many lengths, a term table of some thousand rows."""
    rng = random.Random(7)
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    listed = list(dict.fromkeys(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(3000)))
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {}
    for r in tm.exact_matches(df, "id", "t", tm.term_table(spark, listed)).collect():
        got.setdefault(r.id, set()).add(r.term)
    assert got == {i: b for i, t in enumerate(texts) if (b := brute(t, listed, False))}
    with pytest.raises(ValueError):
        tm.term_table(spark, ["sea-side"])


@pytest.mark.parametrize("ratio", [0.84, 0.7, 0.95])
def test_index_finds_every_similar_pair_with_fewer_candidates(spark, ratio):
    rng = random.Random(2)
    def word(n):
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    listed = list({word(rng.randint(4, 11)) for _ in range(60)})
    words = set(word(rng.randint(1, 12)) for _ in range(900))
    for t in listed:  # near copies: a letter more, less, other, two swapped
        i = rng.randrange(len(t))
        words |= {t, t + "a", t[:i] + t[i + 1:], t[:i] + "z" + t[i + 1:], t[:i] + t[i:][::-1][:2] + t[i + 2:]}
    w = spark.createDataFrame([(x,) for x in words], "word string").repartition(3)
    t = spark.createDataFrame([(x,) for x in listed], "term string")
    pairs = tm.fuzzy_candidates(w, t, ratio)
    got = {(r.word, r.term) for r in pairs.filter(tm.ratcliff_ratio("word", "term") >= ratio).collect()}
    assert got == {(a, b) for a in words for b in listed if similar(a, b, ratio)}
    by_length = sum(2 * min(len(a), len(b)) >= ratio * (len(a) + len(b)) for a in words for b in listed)
    assert len(got) <= pairs.count() < by_length / 3
    # nothing is a nested loop over words and terms
    assert not re.search("NestedLoop|Cartesian", pairs._jdf.queryExecution().executedPlan().toString())


def test_signals_by_rule_table(spark):
    """A group fires once however many of its terms match; votes count distinct terms, ties by order."""
    kw = {"sun": {"terms": ["sun", "sunny day", "beach"], "weights": {"beach": 2}}, "old": {"terms": ["old"], "weights": {"culture": 3, "nightlife": -1}}}
    wx = {"Warm": ["sun", "beach"], "Cool": ["old", "snow"]}
    df = spark.createDataFrame([(1, "sun beach Sunny day"), (2, "old snow and sun"), (3, "nothing"), (4, None), (5, "beachs")], "id long, t string")
    got = {r.id: r for r in text_signals(text_terms(df, "id", "t", kw, wx), kw, wx).collect()}
    assert (got[1].text_weights.beach, got[1].text_weather, list(got[1].matched_keywords)) == (2, "Warm", ["sun"])
    assert (got[2].text_weights.culture, got[2].text_weights.nightlife, got[2].text_weather, list(got[2].matched_keywords)) == (3, -1, "Cool", ["sun", "old"])
    assert got[3].text_weather is None and list(got[4].matched_keywords) == []
    assert list(got[5].matched_keywords) == ["sun"]
    assert text_signals(text_terms(df.limit(0), "id", "t", kw, wx), kw, wx).count() == 0
    assert df.select(F.lit(1)).count() == 5


def test_a_long_text_takes_linear_work(spark):
    """One row per word and per found term, none per place of a word with the words after it."""
    n = 60_000
    df = spark.createDataFrame([(1, "xhot " + "wordy hot " * n + "too"), (2, "not  too"), (3, "xnot too")], "id long, t string")
    out = tm.exact_matches(df, "id", "t", tm.term_table(spark, ["hot", "hot too", "not too", "hot wordy hot wordy"]))
    started = time.time()
    assert {tuple(r) for r in out.collect()} == {(1, "hot"), (1, "hot too"), (1, "hot wordy hot wordy"), (3, "not too")}
    assert time.time() - started < 30
