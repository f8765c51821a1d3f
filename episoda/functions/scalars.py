"""Scalar column functions with one treatment of missing, NaN and infinite values.

Spark orders NaN above every number, so a comparison such as NaN > x is true. Everything here turns what is not finite into null first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def number(value: Column) -> Column:
    """Lenient cast: text that is no number becomes null instead of an error."""
    return value.try_cast("double")


def finite(value: Column) -> Column:
    """value, or null where it is null, NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) < INF), value)


def finite_or(value: Column, default: float | Column | None) -> Column:
    return F.coalesce(finite(value), default if isinstance(default, Column) else F.lit(default).cast("double"))


def truth(text: Column) -> Column:
    """true, 1 or yes in any case; anything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """n / d within 0 and 1; where d is not a positive finite number, 1 if n is positive and else 0."""
    d = finite(denominator.cast("double"))
    return F.when(d > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), numerator / d))).otherwise(F.when(numerator > 0, 1.0).otherwise(0.0))


def safe_rate(count: Column, rows: Column) -> Column:
    """count / rows, null for no rows."""
    return F.try_divide(count.cast("double"), rows.cast("double"))


def last_parts(path: Column, n: int = 3) -> Column:
    """The last n components of a path."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - (n - 1), F.lit(1)), n), "/")


def codes(*rules: tuple[str, Column]) -> Column:
    """The codes whose predicate holds, in the order given; a null predicate does not hold."""
    return F.array_compact(F.array(*[F.when(p, F.lit(c)) for c, p in rules]))


#: Prefix of a code and the category it belongs to.
CATEGORIES = (("T_", "temporal"), ("S_", "synchronisation"), ("C_", "content"), ("V_", "value"))


def categories(code_list: Column) -> Column:
    """Categories of a code list in order of first appearance."""
    of = lambda c: F.coalesce(*[F.when(c.startswith(p), F.lit(name)) for p, name in CATEGORIES], F.lit("value"))
    return F.array_distinct(F.transform(code_list, of))


def has_prefix(code_list: Column, *prefixes: str) -> Column:
    def any_of(c: Column) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | c.startswith(p)
        return out

    return F.exists(code_list, any_of)


def has(code_list: Column, *names: str) -> Column:
    """Whether any of the codes is in the list."""
    return F.arrays_overlap(code_list, F.array(*[F.lit(n) for n in names]))


def spearman_rank(partition: list[str], value: str, descending: bool = True) -> Column:
    """Average rank: ties share the mean of their positions."""
    from pyspark.sql import Window

    order = F.col(value).desc() if descending else F.col(value).asc()
    by_rank = Window.partitionBy(*partition).orderBy(order)
    ties = Window.partitionBy(*partition, value)
    return F.rank().over(by_rank) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
