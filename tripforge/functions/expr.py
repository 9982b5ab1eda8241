"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripforge import rules


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int = 2) -> Column:
    """pandas/numpy ``.round(d)``: scale, round half to even, unscale.

    Written as ``rint(x * 10^d) / 10^d`` (``Math.rint`` rounds half to even on
    the double itself, no BigDecimal per value) so that the oracle SQL
    ``round_even(x * 10^d, 0) / 10^d`` gives bit-identical doubles.
    """
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def sql_round(expr: str, digits: int = 2) -> str:
    """Same rounding as :func:`round_half_even`, as DuckDB SQL text."""
    scale = f"{float(10 ** digits)!r}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def clamp(c, lo=0.0, hi=100.0) -> Column:
    """Clamp into [lo, hi]; null stays null (greatest/least would skip it)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def flag(predicate: Column) -> Column:
    """pandas comparison semantics: a null comparison is False, never null."""
    return F.coalesce(predicate, F.lit(False))


def bucketize_upper(c, rules_: Sequence[tuple], default: str,
                    null_label: str | None = None) -> Column:
    """Threshold labels: ``[(bound, inclusive, label), ...]`` tried in order."""
    c = col(c)
    expr = None
    for bound, inclusive, label in rules_:
        cond = c <= F.lit(bound) if inclusive else c < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(default))
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def level_from_lower(c, rules_: Sequence[tuple], default: str) -> Column:
    """Level labels ``[(lower_bound_inclusive, label), ...]`` from the top."""
    c = col(c)
    expr = None
    for bound, label in rules_:
        cond = c >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def row_sum_min_count(cols: Iterable) -> Column:
    """Row sum skipping nulls; null only when every input is null."""
    cols = [col(c) for c in cols]
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0))
        total = term if total is None else total + term
    any_present = F.lit(False)
    for c in cols:
        any_present = any_present | c.isNotNull()
    return F.when(any_present, total)


def row_sum_null_as_zero(cols: Iterable) -> Column:
    total = None
    for c in cols:
        term = F.coalesce(col(c), F.lit(0))
        total = term if total is None else total + term
    return total


def row_mean(cols: Sequence) -> Column:
    """Mean over the non-null inputs (pandas ``mean(axis=1)``)."""
    values = F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    n = F.size(values)
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(n > 0, total / n)


def row_std_sample(cols: Sequence) -> Column:
    """Sample standard deviation (ddof=1) over the non-null inputs."""
    values = F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = rules.EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres."""
    rlat1, rlat2 = F.radians(col(lat1)), F.radians(col(lat2))
    dlat = rlat2 - rlat1
    dlon = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(rlat1) * F.cos(rlat2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * radius_m) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def sql_haversine_m(lat1: str, lon1: str, lat2: str, lon2: str,
                    radius_m: float = rules.EARTH_RADIUS_M) -> str:
    return (
        f"({2 * radius_m!r} * asin(sqrt(least(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2), 1.0))))"
    )


def map_lookup(mapping: Mapping, key, default=None) -> Column:
    """``mapping.get(key, default)`` as a literal map lookup."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), col(key))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def season_from_month_name(month, mapping: Mapping = rules.MONTH_TO_SEASON) -> Column:
    """``strip().lower()`` lookup; unknown month -> null (callers reject it)."""
    return map_lookup(mapping, F.lower(F.trim(col(month))))


def season_from_month_number(month_num, seasons: Mapping = rules.SEASON_MONTHS) -> Column:
    m = col(month_num)
    expr = None
    for season, months in seasons.items():
        cond = m.isin(months)
        expr = F.when(cond, F.lit(season)) if expr is None else expr.when(cond, F.lit(season))
    return expr


def argmax_with_margin(named: Sequence[tuple[str, Column]], margin: float,
                       tie_label: str = "Balanced") -> Column:
    """Label of the largest score unless it beats the runner-up by <= margin.

    Equal best scores give a difference of 0 and hence ``tie_label``.
    Ordering among equal scores keeps the listed order (stable sort).
    """
    items = [F.struct(F.lit(-i).alias("pos"), col(c).cast("double").alias("score"),
                      F.lit(label).alias("label"))
             for i, (label, c) in enumerate(named)]
    ordered = F.array_sort(
        F.array(*items),
        lambda a, b: F.when(a.score > b.score, -1).when(a.score < b.score, 1)
        .when(a.pos > b.pos, -1).when(a.pos < b.pos, 1).otherwise(0),
    )
    best, second = ordered[0], ordered[1]
    return F.when(best.score - second.score <= F.lit(margin), F.lit(tie_label)).otherwise(best.label)


def join_fragments(fragments: Sequence[Column], sep: str, first_k: int | None = None,
                   default: str | None = None) -> Column:
    """Join the non-null fragments (first k) with ``sep``; default when none."""
    arr = F.filter(F.array(*fragments), lambda x: x.isNotNull())
    if first_k is not None:
        arr = F.slice(arr, 1, first_k)
    joined = F.array_join(arr, sep)
    if default is not None:
        joined = F.when(F.size(arr) == 0, F.lit(default)).otherwise(joined)
    return joined


def fmt1(c) -> Column:
    """``%.1f`` of a value first rounded half-even at one decimal."""
    return F.format_string("%.1f", round_half_even(c, 1))


def sql_fmt1(expr: str) -> str:
    return f"printf('%.1f', {sql_round(expr, 1)})"
