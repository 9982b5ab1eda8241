"""Pipeline stages and their operators on clashing columns, repeated rows and one very long text; how often a text meets Python."""

import random
import re
import time
from collections import Counter

import pytest

CLASH = ["_id", "_key", "_node", "_rows", "_p", "_own_score", "lang_pred", "score", "row", "letters", "node", "best_node", "h", "copies", "place", "one", "ids2"]


def wide(spark):
    rng = random.Random(6)
    words = ["der", "the", "und", "and", "haus", "house", "river", "fluss", "grün", "green", "alpha", "beta"]
    rows = []
    for i in range(90):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(6, 60))) if i % 9 else ("" if i % 2 else None)
        rows.append((i, text, ("en", "de", None)[i % 3], ("a", "b", None)[i % 3], len(text or ""), *[f"{c}{i}" for c in CLASH]))
    rows += [rows[4]] * 3 + [rows[5]] * 2 + [(None, "no id at all here and there", None, None, 27, *CLASH)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)).repartition(4)


def test_stages_keep_clashing_columns(spark):
    import corpus_pipeline as C
    d = wide(spark).cache()
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, d, "")
        rows = out.collect()
        assert out.columns == d.columns and rows
        own = {tuple(r[c] for c in CLASH) for r in d.collect()}
        assert {tuple(r[c] for c in CLASH) for r in rows} <= own, name
        assert all(r["_id"] == f"_id{r['doc_id']}" and r["score"] == f"score{r['doc_id']}" for r in rows if r["doc_id"] is not None)
    empty = d.limit(0)
    assert all(stage(spark, empty, "").count() == 0 for _, stage in C.STAGES)


def test_operators_replace_only_their_own_columns(spark):
    from tripforge.llm import language
    d = wide(spark)
    for model in (language.fit(d), {"langs": [], "net": {}}):
        out = language.predict(d, model)
        assert set(out.columns) == set(d.columns) and dict(out.dtypes)["score"] == "double"
        assert {r["_p"] for r in out.collect()} == {r["_p"] for r in d.collect()}


def test_a_text_meets_python_once(spark, tmp_path):
    """Nodes of Python workers in the plans of the stages over a written table."""
    import corpus_pipeline as C
    wide(spark).write.parquet(str(tmp_path / "docs"))
    d = spark.read.parquet(str(tmp_path / "docs"))
    nodes = {}
    for name, stage in C.STAGES:
        out = stage(spark, d, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        nodes[name] = len(re.findall(r"ArrowEvalPython|MapInArrow|MapInPandas", final))
    assert nodes["language_id"] == nodes["secret_scan"] == nodes["byte_bpe"] == 1
    # what the stage wrote about the texts says which stay; only rows that share an id are hashed again
    assert nodes["ngram_jaccard"] == 1 and nodes["source_mixing"] == 0


def test_copies_of_equal_rows_are_whole(spark, monkeypatch):
    """Copies of rows of one key add up to what the mix takes of them, over parts of bounded size."""
    from tripforge.llm import mixing
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 4)
    rows = [(1, "one two three", "a", k) for k in range(23)] + [(2, "other words here and there", "b", 0), (3, "x y", "a", 0), (4, None, "a", 0), (5, " ", "b", 1), (5, " ", "b", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    got = Counter((r["doc_id"], r["extra"]) for r in mixing.repeat_documents(d).collect())
    mix = [r for r in mixing.mix(d).collect() if r["doc_id"] == 1]
    exact = sum(r["taken"] / r["size"] for r in mix)
    one = [got[1, k] for k in range(23)]
    assert abs(sum(one) - exact) <= len(mix) and max(one) - min(one) <= 1
    # every equal row has the same seeded fraction: their copies are those of the rows, none lost to a floor
    from pyspark.sql import functions as F
    u = (F.pmod(F.xxhash64(F.lit("copies"), "h"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    want = mixing.mix(d).filter("size > 0").groupBy("doc_id").agg(F.sum(F.floor(F.col("taken") / F.col("size") + u)).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in want} == {i: sum(n for (j, _), n in got.items() if j == i) for i in (1, 2, 3)}
    assert got[4, 0] == 1 and got[5, 1] == got[5, 2] == 1


def test_keep_one_of_repeated_rows(spark):
    from tripforge.llm import jaccard
    t = "one two three four five six seven eight nine ten"
    rows = [(2, t, "b"), (2, t, "a"), (2, t, "c"), (7, t + " eleven", "d"), (9, "unlike the others in every word", "e"), (None, "", "f"), (None, "", "f")]
    d = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((tuple(r) for r in jaccard.keep_one(d).collect()), key=str)
    assert got == sorted([(2, t, "a"), (9, "unlike the others in every word", "e"), (None, "", "f"), (None, "", "f")], key=str)


# ------------------------------------------------------- one very long text
LONG = 1 << 20


@pytest.mark.parametrize("text", ["-" * LONG, "7" * LONG, "a" + "!" * LONG + "z", "0123456789" * (LONG // 10), "ab" * (LONG // 2), "a " * (LONG // 2)],
                         ids=["dashes", "digits", "signs", "numbers", "letters", "spaced"])
def test_disguises_of_one_megabyte(text):
    from tripforge.llm import toxicity
    at = time.process_time()
    tokens = list(toxicity.disguised(text))
    assert time.process_time() - at < 2
    spelling = toxicity.Spelling({"bad": 3, "word": 2})
    at = time.process_time()
    for t in tokens:
        spelling.read(t)
    assert time.process_time() - at < 60


def test_disguises_are_found_as_before():
    """The anchored patterns match what the plain ones match."""
    from tripforge.llm import toxicity as X
    inner = re.compile(r"[^\w\s]+(?=[^\W\d_])|[0-9_]+(?=[^\W\d_])")
    last = re.compile(r"(?<=[^\W\d_])[0-9@$!|+(<#*]+(?=[^\w\s]*(?!\S))")
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choice("ab1_!-. @é") for _ in range(rng.randint(0, 24)))
        assert [m.span() for m in inner.finditer(t)] == sorted(m.span() for p in (X._INNER_SIGNS, X._INNER_DIGITS) for m in p.finditer(t))
        assert [m.span() for m in last.finditer(t)] == [m.span() for m in X._LAST.finditer(t)]


def test_many_secrets_in_one_text():
    from tripforge.llm import secret_scan as S
    kinds = {"hex": ["0123abcd" * 3 + "%08x" % i for i in range(60)]}
    model = S.train(kinds, ["internationalisation", "responsibilities12"])
    text = " ".join(f"password = hunter{i} and plainwordswithoutend{i}" for i in range(100_000))
    at = time.process_time()
    spans = S.all_spans(text, model)
    assert time.process_time() - at < 30 and sum(k == 0 for _, k, _ in spans) == 100_000


def test_rest_equals_a_walk_over_all_spans():
    from tripforge.llm import secret_scan as S
    rng = random.Random(2)
    for _ in range(2000):
        spans = sorted((a, rng.randint(0, 2), a + rng.randint(1, 12), "") for a in (rng.randint(0, 40) for _ in range(rng.randint(0, 6))))
        s = rng.randint(0, 30)
        e = s + rng.randint(1, 25)
        covered = {i for a, _, b, _ in spans for i in range(a, b)}
        got = S.Base(spans).rest(s, e)
        assert [i for a, b in got for i in range(a, b)] == [i for i in range(s, e) if i not in covered]
        assert all(a < b for a, b in got)


def test_formats_are_scored_to_their_end():
    """A prefix of a format is not the format: the automaton's probabilities sum to one over whole strings."""
    from tripforge.llm import secret_scan as S
    keys = ["AB" + f"{i:04d}" for i in range(50)]
    model = S.train({"hex": keys}, ["wordlike", "numbers12"])
    assert S.ratio("AB0123", model) > S.ratio("AB012", model) + 2
    steps, end = model["automata"][0][0]
    total = sum(S.CLASS_SIZE[c] * 2.718281828459045 ** p for c, (p, _) in steps.items()) + 2.718281828459045 ** end
    assert total == pytest.approx(1.0)


def test_two_states_merge_by_hand():
    """Strings d, dd, ddd...: the tree of digits becomes one state that loops, its counts added up."""
    from tripforge.llm import secret_scan as S
    a = S.Automaton(["d" * (1 + i % 4) for i in range(400)])
    assert len(a.moves) == 5 and a.total(0) == 400 and a.ends == [0, 100, 100, 100, 100]
    b = S.Automaton(["d" * n for n in range(1, 9) for _ in range(2 ** (9 - n))])
    b.merge_states()
    loops = [q for q in range(len(b.moves)) if b.moves[q].get("d") == q]
    assert len(b.moves) < 9 and loops
    assert sum(b.ends) == sum(2 ** (9 - n) for n in range(1, 9))
