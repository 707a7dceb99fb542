"""Keeping one row per key, pivots over a declared domain, and one-row look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_one(df: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``first_by``, the same one on every run.

    An aggregate rather than ``row_number``: copies of a key shrink to one before the shuffle.
    """
    rest = ", ".join(f"`{c}`" for c in df.columns if c not in keys)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.expr(f"struct({rest})"), F.struct(*first_by)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def flag_matrix(df: DataFrame, key: str, pivots: Sequence[tuple[str, Sequence[int], str]]) -> DataFrame:
    """Pivot presence of (key, position) rows into 0/1 columns, one per declared position.

    Each pivot is (position column, declared positions, name pattern such as ``{}_weeks_back``). The
    positions present are gathered as a set, never longer than the declared domain, so one shuffle
    on the key serves all pivots. The many flags are written as SQL text: one call builds them all.
    """
    inside = [
        F.expr(f"CASE WHEN `{p}` IN ({', '.join(str(int(n)) for n in domain)}) THEN `{p}` END") for p, domain, _ in pivots
    ]
    present = (
        df.filter(F.coalesce(*inside).isNotNull())
        .groupBy(key)
        .agg(*[F.collect_set(c).alias(f"_present_{i}") for i, c in enumerate(inside)])
    )
    flags = [
        f"CAST(array_contains(_present_{i}, {int(p)}) AS INT) AS `{name.format(p)}`"
        for i, (_, domain, name) in enumerate(pivots)
        for p in domain
    ]
    return present.selectExpr(f"`{key}`", *flags)


def as_one_row(df: DataFrame, position: str, value: str, positions: Sequence[int], name: str) -> DataFrame:
    """Turn (position, value) rows into one row with a column per declared position, 0 if absent."""
    wide = df.groupBy().pivot(position, list(positions)).agg(F.max(value))
    return wide.toDF(*[name.format(p) for p in positions]).na.fill(0)


def attach_one_row(df: DataFrame, one_row: DataFrame, optional: bool = False) -> DataFrame:
    """Put the columns of a one-row frame on every row, as a scalar subquery.

    A frame without a row raises, unless it is ``optional``; its columns are NULL then.
    """
    one = one_row.select(F.struct("*")).scalar()
    if not optional:
        one = F.coalesce(one, F.raise_error(F.lit(f"no row to attach with columns {', '.join(one_row.columns)}")))
    return df.select("*", one.alias("_one")).select(*df.columns, "_one.*")


def latest(df: DataFrame, value: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order``: what ORDER BY ... DESC LIMIT 1 returns."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(1).select(*value)


def top(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col(tie)).limit(k)


def override(new: Column, old: Column) -> Column:
    return F.coalesce(new, old)
