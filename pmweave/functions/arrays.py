"""Counter kinds and the expansion of array counters.

A raw counter is a comma-joined string. ``Single`` is one value, ``PDF[n]`` a fixed
array, ``COMP[n]`` a sparse array ``count,index,value,index,value...`` and
``SPECIAL`` a fixed array of ten.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Counter kinds and the value of an absent or blank element.
SINGLE, PDF, COMP, SPECIAL = "Single", "PDF", "COMP", "SPECIAL"
SPECIAL_DIM = 10
ZERO = "0"


def counter_kind(spec: Column) -> Column:
    """``Single`` | ``PDF`` | ``COMP`` | ``SPECIAL``; null for anything else."""
    return (
        F.when(spec == SINGLE, F.lit(SINGLE))
        .when(F.contains(spec, F.lit(PDF)), F.lit(PDF))
        .when(F.contains(spec, F.lit(COMP)), F.lit(COMP))
        .when(F.contains(spec, F.lit(SPECIAL)), F.lit(SPECIAL))
    )


def counter_dim(spec: Column) -> Column:
    """Number of output columns of a counter; null for an unknown kind or a bad size."""
    kind = counter_kind(spec)
    size = F.nullif(F.regexp_extract(spec, r"\[\s*(\d+)\s*\]", 1), F.lit("")).try_cast("int")
    return (
        F.when(kind == SINGLE, F.lit(1))
        .when(kind == SPECIAL, F.lit(SPECIAL_DIM))
        .when(kind.isNotNull(), size)
    )


def values_of(raw: Column) -> Column:
    return F.split(raw, ",")


def _or_zero(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(ZERO))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where the body uses it inside a lambda.

    The finish of a reduction over nothing: unlike ``transform`` it hands on what it is given and makes no deep copy.
    """
    return F.reduce(F.array().cast("array<int>"), value, lambda same, _: same, body)


def _fixed(values: Column, n: int) -> Column:
    """Exactly n elements, cut or padded with zero."""
    some = F.coalesce(values, F.array().cast("array<string>"))
    return F.slice(F.concat(some, F.array_repeat(F.lit(ZERO), n)), 1, n)


def expand_single(raw: Column) -> Column:
    """The first value of a scalar counter, zero when absent."""
    return F.coalesce(F.substring_index(raw, ",", 1), F.lit(ZERO))


def expand_pdf(raw: Column, n: int) -> Column:
    """Exactly n values: cut or padded with zero, blanks become zero."""
    return F.transform(_fixed(values_of(raw), n), _or_zero)


def expand_comp(raw: Column, n: int) -> Column:
    """A sparse list as n dense values.

    Indexes outside 0..n-1 are ignored, the last of a repeated index wins, and only
    as many pairs count as the list announces and really holds.
    """

    def pairs_of(values: Column) -> Column:
        announced = F.coalesce(F.get(values, F.lit(0)).try_cast("int"), F.lit(0))
        held = F.floor((F.size(values) - 1) / 2).cast("int")
        count = F.greatest(F.least(announced, held), F.lit(0))
        # sequence(1, 0) would count down, so the empty list needs its own branch
        numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            numbers,
            lambda p: F.struct(
                F.get(values, 2 * p - 1).try_cast("int").alias("at"), F.get(values, 2 * p).alias("value")
            ),
        )

    def dense(pairs: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: F.coalesce(
                F.try_element_at(F.filter(pairs, lambda p: p["at"] == i), F.lit(-1))["value"], F.lit(ZERO)
            ),
        )

    return bind(bind(values_of(raw), pairs_of), dense)


def comp_is_short(raw: Column) -> Column:
    """True when a sparse list holds fewer pairs than it announces, or announces no number."""
    values = values_of(raw)
    announced = F.get(values, F.lit(0)).try_cast("int")
    return F.coalesce(announced * 2 + 1 > F.size(values), raw.isNotNull())


def comp_is_long(raw: Column, n: Column) -> Column:
    """True when a sparse list holds values that ``expand_comp`` has no place for: more than announced, or with an index outside 0..n-1."""

    def outside(values: Column) -> Column:
        announced = F.get(values, F.lit(0)).try_cast("int")
        pairs = F.filter(F.slice(values, F.lit(2), F.size(values)), lambda _, i: i % 2 == 0)
        indexes = F.slice(pairs, F.lit(1), F.greatest(F.least(announced, F.floor((F.size(values) - 1) / 2).cast("int")), F.lit(0)))
        readable = lambda at: F.coalesce((at.try_cast("int") >= 0) & (at.try_cast("int") < n), F.lit(False))
        return (F.size(values) > 2 * announced + 1) | F.exists(indexes, lambda at: ~readable(at))

    return F.coalesce(bind(values_of(raw), outside), F.lit(False))


def expand_special(raw: Column) -> Column:
    """The first ten values, zero where the list is shorter or the counter absent."""
    return _fixed(values_of(raw), SPECIAL_DIM)


def expand(raw: Column, kind: str, dim: int) -> Column:
    """An array of ``dim`` values for one configured counter."""
    if kind == SINGLE:
        return F.array(expand_single(raw))
    if kind == PDF:
        return expand_pdf(raw, dim)
    if kind == COMP:
        return expand_comp(raw, dim)
    if kind == SPECIAL:
        return expand_special(raw)
    raise ValueError(f"unknown counter kind {kind!r}")
