"""Rule terms in texts (F2, F3, F4, UD1): joins instead of one pattern per rule.

Rules are a table with one row per term. Texts become rows of pieces (words and what
stands between them) that meet the terms in equality joins:

* a term of one word matches a whole word: the distinct words of a text join the terms;
* a term of several words matches as a plain substring: it may begin inside a word
  and end inside another, with exactly its own separators between. Its first word
  is a suffix of some word, so the distinct words' suffixes of the lengths that first
  words have join the terms' first words, and only texts that hold such a word are
  searched for the term;
* a term of one word of ``min_len`` letters or more also matches a similar word
  (Ratcliff/Obershelp ratio). An index of lengths and letter counts finds the
  candidates, see ``fuzzy_candidates``; the ratio itself runs in a pandas UDF on the
  distinct pairs that are left.

So the work grows with the words of the texts and with what matches, not with texts
times terms. The term table may be of any size; Spark broadcasts it if it is small.

Defined results: a null or empty text matches nothing; a text's id stands for one
text, rows of one id are taken together; matching ignores case (``lower``).
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import rules

#: Word characters, as a class of Java's and RE2's patterns.
WORD = r"\p{L}\p{N}_"


@F.pandas_udf(T.DoubleType())
def ratcliff_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """UD1: Ratcliff/Obershelp similarity, argument order kept."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def all_terms(keywords: Mapping[str, Mapping], weather: Mapping[str, Sequence[str]]) -> list[str]:
    """The distinct terms of both rule sets."""
    return list(dict.fromkeys([t for cfg in keywords.values() for t in cfg["terms"]] + [t for ts in weather.values() for t in ts]))


def term_table(spark: SparkSession, terms: Iterable[str]) -> DataFrame:
    """(term, first, pieces): a term's first word, and how many words and separators it has."""
    rows = []
    for t in terms:
        parts = re.findall(r"\w+|\W+", t)
        if not parts or not re.fullmatch(r"\w+", parts[0]) or (" " not in t and len(parts) > 1):
            raise ValueError(f"a term is one word, or starts with a word and holds a blank: {t!r}")
        rows.append((t, parts[0], len(parts)))
    return spark.createDataFrame(rows, "term string, first string, pieces int")


def exact_matches(texts: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """(id, term): whole words, and substrings for terms of several words."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = texts.select(F.col(id_col).alias("id"), low.alias("low"))
    words = rows.select("id", F.explode(F.array_distinct(F.regexp_extract_all("low", F.lit(f"[{WORD}]+"), F.lit(0)))).alias("word"))
    known = words.select("word").distinct()
    whole = known.join(terms.filter("pieces = 1").select(F.col("term").alias("word")), "word").select("word", F.col("word").alias("term"), F.lit(True).alias("sure"))
    several = terms.filter("pieces > 1").select("term", "first")
    sizes = several.agg(F.array_sort(F.collect_set(F.length("first")))).first()[0]  # lengths: few numbers
    if not sizes:
        return words.join(whole, "word").select("id", "term").distinct()
    # distinct words that end with a first word; whether the rest follows is seen in the texts that hold them
    ends = known.select("word", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).filter(F.length("word") >= F.col("n"))
    begun = ends.select("word", F.expr("right(word, n)").alias("first")).join(several, "first").select("word", "term", F.lit(False).alias("sure"))
    met = words.join(whole.unionByName(begun), "word").groupBy("id", "term").agg(F.max("sure").alias("sure"))
    asked = met.filter("not sure").groupBy(F.col("id").alias("own")).agg(F.collect_list("term").alias("terms"))  # at most one entry per rule term
    held = rows.join(asked, F.col("id").eqNullSafe(F.col("own"))).select("id", F.explode(F.filter("terms", lambda t: F.contains(F.col("low"), t))).alias("term"))
    return met.filter("sure").select("id", "term").unionByName(held).distinct()


# ------------------------------------------------------------------- F4, UD1
def _letters(word: Column, group: Column, groups: Column) -> Column:
    """The letters of one group of the alphabet, sorted: equal for equal counts."""
    return F.array_join(F.array_sort(F.filter(F.split(word, ""), lambda c: (c != "") & (F.pmod(F.ascii(c), groups) == group))), "")


def _budget(a: Column, b: Column, ratio: float) -> Column:
    """Letters that may be left over on both sides together: of a + b, all but ratio * (a + b)."""
    return F.floor((a + b) * F.lit(1.0 - ratio) + F.lit(1e-9)).cast("int")


def fuzzy_candidates(words: DataFrame, terms: DataFrame, ratio: float = rules.FUZZY_RATIO) -> DataFrame:
    """(word, term) pairs that can reach ``ratio``, from ``words`` (word) and ``terms`` (term).

    The ratio is 2 * matched / (a + b) letters, so at most ``u = (1 - ratio)(a + b)``
    letters of both are left over. With the alphabet cut into u + 1 groups, one
    group at least holds none of them, and there both words have equal letter
    counts: the index key is (both lengths, group, its letters in order). Pairs that
    share a key still have to pass the bound of all letter counts together."""
    lengths = terms.agg(F.array_sort(F.collect_set(F.length("term")))).first()[0]  # a few numbers
    every = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    w = words.select("word", F.length("word").alias("a"), every.alias("bs"))
    w = w.select("word", "a", F.explode(F.expr(f"filter(bs, b -> abs(a - b) <= floor((a + b) * {1.0 - ratio!r} + 1e-9))")).alias("b"))
    w = w.select("word", "a", "b", _budget(F.col("a"), F.col("b"), ratio).alias("u")).withColumn("g", F.explode(F.expr("sequence(0, u)")))
    w = w.select("word", "a", "b", "g", _letters(F.col("word"), F.col("g"), F.col("u") + 1).alias("letters"))
    near = F.explode(F.expr(f"filter(sequence(1, 3 * length(term)), a -> abs(a - length(term)) <= floor((a + length(term)) * {1.0 - ratio!r} + 1e-9))"))
    t = terms.select("term", F.length("term").alias("b"), near.alias("a"))
    t = t.withColumn("u", _budget(F.col("a"), F.col("b"), ratio)).withColumn("g", F.explode(F.expr("sequence(0, u)")))
    t = t.select("term", "a", "b", "g", _letters(F.col("term"), F.col("g"), F.col("u") + 1).alias("letters"))
    pairs = w.join(t, ["a", "b", "g", "letters"]).select("word", "term", "a", "b").distinct()
    # letters in common, counted
    common = F.expr("aggregate(array_distinct(filter(split(word, ''), c -> c != '')), 0, "
                    "(n, c) -> n + least(length(word) - length(replace(word, c, '')), length(term) - length(replace(term, c, ''))))")
    return pairs.filter(2.0 * common >= F.lit(ratio) * (F.col("a") + F.col("b")) - 1e-9).select("word", "term")


def fuzzy_matches(texts: DataFrame, id_col: str, text_col: str, terms: DataFrame, ratio: float = rules.FUZZY_RATIO,
                  min_len: int = rules.FUZZY_MIN_TERM_LENGTH) -> DataFrame:
    """(id, term): some run of letters of the text is similar to the term."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    tokens = texts.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit("[a-zA-Z]+"), F.lit(0)))).alias("word"))
    pairs = fuzzy_candidates(tokens.select("word").distinct(), terms.filter((F.col("pieces") == 1) & (F.length("term") >= min_len)).select("term"), ratio)
    similar = pairs.filter(ratcliff_ratio("word", "term") >= ratio)
    return tokens.join(similar, "word").select("id", "term").distinct()


# ------------------------------------------------------------------- oracle
def sql_close(ratio: float) -> str:
    """Whether ``word`` and ``term`` have letters enough in common to reach ``ratio``, in DuckDB SQL."""
    letters = "[" + ", ".join(f"'{chr(c)}'" for c in range(97, 123)) + "]"
    common = (f"list_sum(list_transform({letters}, lambda c: least(length(word) - length(replace(word, c, '')), "
              "length(term) - length(replace(term, c, '')))))")
    return (f"2.0 * least(length(word), length(term)) >= {ratio} * (length(word) + length(term)) "
            f"AND 2.0 * {common} >= {ratio} * (length(word) + length(term)) - 1e-9")


def sql_ratcliff(pairs: str, name: str = "ratcliff") -> str:
    """DuckDB CTEs (for WITH RECURSIVE): ``{name}`` (word, term, ratio) of the distinct
    ``pairs`` (word, term): the longest common block, leftmost in the first word, then in
    the second, and the same again on either side of it."""
    return f"""{name}_blocks AS (
  SELECT word, term, 1 AS a, length(word) + 1 AS z, 1 AS b, length(term) + 1 AS y, 0 AS k FROM {pairs}
  UNION ALL
  SELECT word, term, part.a, part.z, part.b, part.y, part.k FROM (
    SELECT word, term, unnest([{{'a': a, 'z': best.i, 'b': b, 'y': best.j, 'k': best.k}},
                               {{'a': best.i + best.k, 'z': z, 'b': best.j + best.k, 'y': y, 'k': 0}}]) AS part
    FROM (SELECT word, term, a, z, b, y, {{'k': max_k.k, 'i': -max_k.i, 'j': -max_k.j}} AS best FROM (
      SELECT word, term, a, z, b, y, max({{'k': n, 'i': -i, 'j': -j}}) AS max_k FROM (
        SELECT word, term, a, z, b, y, n, a + x AS i, b + v AS j FROM (
          SELECT s.*, unnest(range(0, z - a)) AS x FROM {name}_blocks s WHERE z > a AND y > b), range(0, 40) r(v), range(1, 40) m(n)
        WHERE b + v + n <= y AND a + x + n <= z AND substr(word, a + x, n) = substr(term, b + v, n)) GROUP BY word, term, a, z, b, y)) chosen) split
  WHERE part.z > part.a OR part.k > 0),
{name} AS (SELECT word, term, 2.0 * sum(k) / (length(word) + length(term)) AS ratio FROM {name}_blocks GROUP BY word, term)"""
