"""One page of a listing and the page summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def page_of(df: DataFrame, order: list[str], page: int = 1, limit: int = 40) -> DataFrame:
    """Rows of one page (from 1) under a total order; all rows up to the page are sorted for it."""
    return df.orderBy(*order).offset((page - 1) * limit).limit(limit)


SAMPLED = 30
#: ranges told apart in one pass: every bound is an expression over all order columns
AT_ONCE = 16


def deep_page(
    df: DataFrame, order: list[str], page: int = 1, limit: int = 40, ranges: int | None = None, seed: int = 1
) -> DataFrame:
    """Rows of one page (from 1) under a total order, however deep; ``-name`` orders downwards.

    A small sample gives the bounds of ``ranges`` ranges (by default one per shuffle partition),
    a count per range tells which of them hold the page, and only the rows of these are sorted.
    Beyond ``AT_ONCE`` ranges, the range that holds the page is cut again in a further pass.
    The bounds are values, so the ranges are the same whenever the rows are read; an uneven
    sample makes uneven ranges and no other rows.
    """
    left = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]
    held, total, skip = df, df.count(), (page - 1) * limit
    while True:
        parts = min(left, AT_ONCE)
        number = range_number(held, order, sort, total, parts, seed)
        sizes = {r[0]: r[1] for r in held.groupBy(number.alias("range")).agg(F.count("*")).collect()}
        before, wanted = 0, []
        for n in sorted(sizes):
            if before + sizes[n] > skip and before < skip + limit:
                wanted.append((n, before))
            before += sizes[n]
        if not wanted:
            return df.limit(0)
        held = held.filter(number.isin([n for n, _ in wanted]))
        skip -= wanted[0][1]
        total = sum(sizes[n] for n, _ in wanted)
        left = -(-left // parts)
        if left == 1:
            return held.orderBy(*sort).offset(skip).limit(limit)


def range_number(df: DataFrame, order: list[str], sort: list[Column], total: int, ranges: int, seed: int) -> Column:
    """Which of ``ranges`` ranges of about one size a row is in, by bounds from a sample of ``df``."""
    few = df.select(list(dict.fromkeys(c.lstrip("-") for c in order)))
    if total > ranges * SAMPLED:
        few = few.sample(ranges * SAMPLED / total, seed)
    few = few.orderBy(*sort).limit(2 * ranges * SAMPLED).collect()
    bounds = [few[len(few) * k // ranges] for k in range(1, ranges)] if few else []
    return bounds_passed(bounds, order)


def bounds_passed(bounds: list[Row], order: list[str], before: int = 0) -> Column:
    """How many of the sorted bounds a row comes after, by halving."""
    if not bounds:
        return F.lit(before)
    half = len(bounds) // 2
    above = bounds_passed(bounds[half + 1 :], order, before + half + 1)
    return F.when(after(bounds[half], order), above).otherwise(bounds_passed(bounds[:half], order, before))


def after(bound: Row, order: list[str]) -> Column:
    """Whether a row comes after a bound; NULL first upwards and last downwards."""
    behind = F.lit(False)
    for c in reversed(order):
        name = c.lstrip("-")
        value, there = bound[name], F.col(name)
        if value is None:
            same, later = there.isNull(), F.lit(False) if c.startswith("-") else there.isNotNull()
        elif c.startswith("-"):
            same, later = there.eqNullSafe(F.lit(value)), F.coalesce(there < F.lit(value), F.lit(True))
        else:
            same, later = there.eqNullSafe(F.lit(value)), F.coalesce(there > F.lit(value), F.lit(False))
        behind = later | (same & behind)
    return behind


def page_summary(df: DataFrame, page: int = 1, limit: int = 40) -> DataFrame:
    """Current page, last page, rows per page and rows in total."""
    total = F.count(F.lit(1))
    last = F.ceil(total / F.lit(limit)).cast("bigint") if limit > 0 else F.lit(1).cast("bigint")
    return df.agg(
        F.lit(page).alias("current_page"),
        last.alias("last_page"),
        F.lit(limit).alias("per_page"),
        total.alias("total"),
    )
