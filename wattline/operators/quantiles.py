"""Exact quantiles without gathering a group's values in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.series import MAX_ROWS, Part, Series, measure, per_series


def value_counts(df: DataFrame, by: Sequence[str], value: str, name: str = "n") -> DataFrame:
    """Distinct present values of each group and how often they occur."""
    v = F.col(value).cast("double")
    return (
        df.select(*by, v.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias(name))
    )


def value_series(rows: DataFrame, by: Sequence[str], value: str = "value", max_rows: int | None = MAX_ROWS) -> Series:
    """Which groups have many values, counted on the rows themselves: cheaper than counting distinct
    values, of which there are at most as many."""
    values = rows.select(*by, F.col(value).cast("double").alias("value"))
    return measure(values.where(~F.isnan("value")), Series(tuple(by), "value", max_rows=max_rows))


def cumulative(counts: DataFrame, series: Series, names: Sequence[str]) -> DataFrame:
    """Add for each count column its running sum in value order (`_upto_*`) and its group total."""

    def build(part: Part, d: DataFrame) -> DataFrame:
        d = part.running(d, {f"_upto_{n}": ("sum", F.col(n), True) for n in names})
        return part.whole(d, {f"_total_{n}": F.sum(n) for n in names})

    return per_series(counts, series, build)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles per group; one row per group that has a value."""
    keys = tuple(by) or ("_all",)
    if not by:
        df = df.withColumn("_all", F.lit(0))
    series = value_series(df, keys, value, max_rows)
    out = quantiles_of_counts(value_counts(df, keys, value), series, quantiles)
    return out if by else out.drop("_all")


def quantiles_of_counts(counts: DataFrame, series: Series, quantiles: Mapping[str, float]) -> DataFrame:
    """The same from distinct values and their counts `n`."""
    by = series.keys
    ranked = cumulative(counts, series, ["n"])

    def place(p: float) -> Column:
        return (F.col("_total_n") - 1) * F.lit(float(p))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto_n") > rank, F.col("value")))

    found = ranked.groupBy(*by).agg(
        F.max("_total_n").alias("_total_n"),
        *[at(F.floor(place(p))).alias(f"_lo_{n}") for n, p in quantiles.items()],
        *[at(F.ceil(place(p))).alias(f"_hi_{n}") for n, p in quantiles.items()],
    )
    return found.select(
        *by,
        *[
            (
                F.col(f"_lo_{n}")
                + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (place(p) - F.floor(place(p)))
            ).alias(n)
            for n, p in quantiles.items()
        ],
    )
