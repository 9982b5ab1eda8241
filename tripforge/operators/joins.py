"""Join helpers: validated left join (J1), plain left join (J2), dedup-then-enrich
(J3), semi-join + attach (J4), lookup with default (J6), similar items (J9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class JoinValidationError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int = 5) -> list:
    """Up to ``limit`` duplicated keys (one aggregation job; partial agg first)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    return [tuple(r[k] for k in keys) for r in dup.limit(limit).collect()]


def left_join_1to1(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   validate: bool = True, broadcast_right: bool = False) -> DataFrame:
    """Left equi-join that fails on duplicate keys on either side."""
    if validate:
        for side, frame in (("left", left), ("right", right)):
            dups = duplicate_keys(frame, keys)
            if dups:
                raise JoinValidationError(f"duplicate keys on the {side} side: {dups}")
    r = F.broadcast(right) if broadcast_right else right
    return left.join(r, list(keys), "left")


def enrich_missing(recs: DataFrame, facts: DataFrame, keys: Sequence[str],
                   fact_columns: Sequence[str]) -> DataFrame:
    """Add only the fact columns ``recs`` lacks; facts deduplicated by key
    (deterministically: the first row by all fact columns)."""
    missing = [c for c in fact_columns if c not in recs.columns and c not in keys]
    available = [c for c in missing if c in facts.columns]
    if not missing:
        return recs
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in available])
    dedup = (facts.select(*keys, *available).withColumn("__rn", F.row_number().over(w))
             .where("__rn = 1").drop("__rn"))
    return recs.join(dedup, list(keys), "left")


def semi_then_attach(df: DataFrame, names: DataFrame | None, scores: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in ``names``, then attach ``scores``. Without
    ``names``, those of ``scores`` count: one join does both, and ``scores`` is made once."""
    if names is None:
        return df.join(scores, list(key))
    return df.join(names, list(key), "left_semi").join(scores, list(key), "left")


def lookup_with_default(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str,
                        out: str, default=None, default_col: str | None = None) -> DataFrame:
    """Lookup in a small rule table (broadcast); missing -> a literal
    default or another column of ``df``."""
    joined = df.join(F.broadcast(table.select(F.col(table_key).alias("__lk"), F.col(value).alias("__lv"))),
                     F.col(key) == F.col("__lk"), "left")
    fallback = F.col(default_col) if default_col else F.lit(default)
    return joined.withColumn(out, F.coalesce(F.col("__lv"), fallback)).drop("__lk", "__lv")


def similar_in_group(df: DataFrame, group: str, name: str, order_col: str | None,
                     key: Sequence[str], k: int = 3) -> DataFrame:
    """Per row, the top ``k`` other members of its group by ``order_col``
    desc (else by name). No self-join: each group's first 2k rows, at most k of
    one name, hold k others for every name; the row's own name is dropped.
    """
    order = [F.col(order_col).desc_nulls_last(), F.col(name)] if order_col else [F.col(name)]
    w = Window.partitionBy(group).orderBy(*order)
    top = (df.select(group, name, *([order_col] if order_col else []))
           .withColumn("__nk", F.row_number().over(Window.partitionBy(group, name).orderBy(*order))).where(F.col("__nk") <= k)
           .withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= 2 * k)
           .groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__rk", F.col(name).alias("n")))).alias("__top")))
    out = df.join(top, group, "left")
    others = F.filter(F.col("__top"), lambda x: x["n"] != F.col(name))
    return out.withColumn("similar_destinations",
                          F.coalesce(F.slice(F.transform(others, lambda x: x["n"]), 1, k),
                                     F.array().cast("array<string>"))).drop("__top")


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection to the listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def coalesce_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Make ``new`` exist from the first present old name / merge suffix."""
    out = df
    for new, olds in aliases.items():
        if new in out.columns:
            continue
        for old in olds:
            if old in out.columns:
                out = out.withColumn(new, F.col(old))
                break
    return out


def require_columns(df: DataFrame, columns: Sequence[str], hint: str = "") -> None:
    """Fail early with the list of what is missing and what exists."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing {', '.join(missing)}. {hint} Available columns: {', '.join(df.columns)}")
