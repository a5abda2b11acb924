"""Row-window features of a series: rolling statistics, lags, future label, position, change rate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.series import Part, Series, ordinal, per_series, positions

AGGS = ("mean", "std", "min", "max")


def rolling_columns(
    df: DataFrame,
    series: Series,
    signals: Sequence[str],
    windows: Sequence[int],
    aggs: Sequence[str] = AGGS,
    min_periods: int | None = None,
    wanted: Iterable[str] | None = None,
) -> DataFrame:
    """Plain definition: one sliding frame per width. NULL until enough non-NULL values are in it."""
    calls = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    keep = None if wanted is None else set(wanted)
    columns = []
    for width in windows:
        frame = series.window().rowsBetween(-(width - 1), 0)
        for signal in signals:
            full = F.count(signal).over(frame) >= (min_periods or width)
            for agg in aggs:
                name = f"{signal}_roll_{agg}_{width}s"
                if keep is None or name in keep:
                    columns.append(F.when(full, calls[agg](signal).over(frame)).alias(name))
    return df.select("*", *columns)


def _stat(signal: str) -> str:
    """Statistics of a one-row frame."""
    v = f"CAST(`{signal}` AS DOUBLE)"
    return (
        f"named_struct('n', IF({v} IS NULL, 0D, 1D), 'mean', coalesce({v}, 0D), 'm2', 0D,"
        f" 'lo', {v}, 'hi', {v}) AS `{signal}`"
    )


def _merge(near: str, far: str, signal: str) -> str:
    """Statistics of two adjoining frames as one; squared deviations are merged without cancellation."""
    a, b = f"{near}.`{signal}`", f"{far}.`{signal}`"
    n = f"({a}.n + coalesce({b}.n, 0D))"
    gap = f"(coalesce({b}.mean, 0D) - {a}.mean)"
    share = f"(coalesce({b}.n, 0D) / greatest({n}, 1D))"
    return (
        f"named_struct('n', {n},"
        f" 'mean', IF({a}.n = 0D, coalesce({b}.mean, 0D), {a}.mean + {gap} * {share}),"
        f" 'm2', {a}.m2 + coalesce({b}.m2, 0D) + {gap} * {gap} * {a}.n * {share},"
        f" 'lo', least({a}.lo, {b}.lo), 'hi', greatest({a}.hi, {b}.hi)) AS `{signal}`"
    )


def rolling_joined(
    df: DataFrame,
    series: Series,
    signals: Sequence[str],
    windows: Sequence[int],
    aggs: Sequence[str] = AGGS,
    min_periods: int | None = None,
    wanted: Iterable[str] | None = None,
) -> DataFrame:
    """Same columns with about 2*log2(width) steps per row instead of `width`.

    A frame of a+b rows is the frame of the last a rows joined with the frame of b rows that ends a
    rows earlier, and that one is a lag away. All steps share one partitioning and one sort.
    """
    keep = None if wanted is None else set(wanted)

    def names(width: int) -> list[tuple[str, str, str]]:
        all_names = [(s, a, f"{s}_roll_{a}_{width}s") for s in signals for a in aggs]
        return [t for t in all_names if keep is None or t[2] in keep]

    widths = [w for w in sorted(set(windows)) if names(w)]
    signals = [s for s in signals if any(t[0] == s for w in widths for t in names(w))]
    if not signals:
        return df
    over = series.window()
    df = df.withColumn("_w1", F.expr("named_struct(" + _fields(_stat(s) for s in signals) + ")"))
    made, previous = {1}, 1

    def join(frame: DataFrame, near: int, far: int) -> DataFrame:
        width = near + far
        if width in made:
            return frame
        made.add(width)
        frame = frame.withColumn("_far", F.lag(f"_w{far}", near).over(over))
        merged = _fields(_merge(f"_w{near}", "_far", s) for s in signals)
        return frame.withColumn(f"_w{width}", F.expr(f"named_struct({merged})")).drop("_far")

    for width in widths:
        unit = previous if width % previous == 0 else 1
        done = 1
        for bit in bin(width // unit)[3:]:  # the digits after the leading one
            df = join(df, done * unit, done * unit)
            done *= 2
            if bit == "1":
                df = join(df, done * unit, unit)
                done += 1
        previous = width

    columns = []
    for width in widths:
        enough = min_periods or width
        for signal, agg, name in names(width):
            s = f"_w{width}.`{signal}`"
            value = {
                "mean": f"{s}.mean",
                "std": f"sqrt({s}.m2 / {s}.n)",
                "min": f"{s}.lo",
                "max": f"{s}.hi",
            }[agg]
            columns.append(f"IF({s}.n >= {enough}, {value}, NULL) AS `{name}`")
    return df.selectExpr("*", *columns).drop(*[f"_w{w}" for w in made])


def _fields(aliased: Iterable[str]) -> str:
    """`expr AS name` items as the arguments of named_struct."""
    pairs = (item.rsplit(" AS ", 1) for item in aliased)
    return ", ".join(f"'{name.strip('`')}', {expr}" for expr, name in pairs)


def lag_columns(df, series, signals, lags, wanted=None) -> DataFrame:
    keep = None if wanted is None else set(wanted)
    over = series.window()
    named = [(s, n, f"{s}_lag_{n}s") for n in lags for s in signals]
    return df.select(
        "*", *[F.lag(s, n).over(over).alias(name) for s, n, name in named if keep is None or name in keep]
    )


def label_columns(df, series, source, horizon, name) -> DataFrame:
    return df.withColumn(name, F.lead(source, horizon).over(series.window())).withColumn(
        "label_available", F.col(name).isNotNull().cast("int")
    )


def rolling(
    df: DataFrame,
    series: Series,
    signals: Sequence[str],
    windows: Sequence[int],
    aggs: Sequence[str] = AGGS,
    min_periods: int | None = None,
) -> DataFrame:
    """Rolling statistics over the last `w` rows; signals the table lacks are skipped."""
    signals = [s for s in signals if s in df.columns]

    def build(part: Part, d: DataFrame) -> DataFrame:
        return part.frames(
            d, lambda x, s: rolling_joined(x, s, signals, windows, aggs, min_periods), back=max(windows) - 1
        )

    return per_series(df, series, build) if signals else df


def lags(df: DataFrame, series: Series, signals: Sequence[str], steps: Sequence[int]) -> DataFrame:
    """Values `n` rows earlier in the same series."""
    signals = [s for s in signals if s in df.columns]
    return per_series(
        df,
        series,
        lambda part, d: part.frames(d, lambda x, s: lag_columns(x, s, signals, steps), max(steps)),
    )


def future_label(
    df: DataFrame,
    series: Series,
    source: str,
    horizon: int,
    name: str,
    max_jump: float | None = None,
) -> DataFrame:
    """Value `horizon` rows ahead; rows whose label jumps by more than `max_jump` are dropped."""
    out = per_series(
        df,
        series,
        lambda part, d: part.frames(
            d, lambda x, s: label_columns(x, s, source, horizon, name), 0, horizon
        ),
    )
    return out if max_jump is None else out.where(plausible(source, name, max_jump))


def plausible(source: str, label: str, max_jump: float) -> Column:
    jump = F.abs(F.col(label) - F.col(source))
    return jump.isNull() | (jump <= max_jump)


def drop_first(df: DataFrame, series: Series, rows: int, name: str = "position") -> DataFrame:
    """Add each row's place in its series and drop the first `rows`, whose frames are not full yet."""
    return positions(df, series, name).where(F.col(name) >= rows)


def window_features(
    df: DataFrame,
    series: Series,
    signals: Sequence[str],
    windows: Sequence[int],
    aggs: Sequence[str],
    steps: Sequence[int],
    source: str,
    horizon: int,
    target: str,
    wanted: Iterable[str] | None = None,
) -> DataFrame:
    """Rolling, lag and label columns together: one shuffle and one sort for all of them."""
    signals = [s for s in signals if s in df.columns]

    def all_columns(x: DataFrame, s: Series) -> DataFrame:
        x = lag_columns(x, s, signals, steps, wanted)
        x = label_columns(x, s, source, horizon, target)
        return rolling_joined(x, s, signals, windows, aggs, None, wanted)

    back = max([w - 1 for w in windows] + list(steps))
    return per_series(df, series, lambda part, d: part.frames(d, all_columns, back, horizon))


def change_rate(df: DataFrame, series: Series, signal: str, name: str, per_s: float = 60) -> DataFrame:
    """Change since the row before, per `per_s` seconds."""

    def build(x: DataFrame, s: Series) -> DataFrame:
        at, over = ordinal(x, s.time), s.window()
        elapsed = (at - F.lag(at).over(over)) / 1e6
        change = F.col(signal) - F.lag(signal).over(over)
        return x.withColumn(name, F.when(elapsed != 0, change / elapsed * per_s))

    return per_series(df, series, lambda part, d: part.frames(d, build, 1))


def elapsed(df: DataFrame, series: Series, name: str = "elapsed_s") -> DataFrame:
    """Seconds since the first row of the series."""
    at = ordinal(df, series.time)
    return per_series(
        df,
        series,
        lambda part, d: part.whole(d, {"_first": F.min(at)})
        .withColumn(name, (at - F.col("_first")) / 1e6)
        .drop("_first"),
    )


def error_band(
    df: DataFrame,
    series: Series,
    pred: str = "pred",
    error: str = "error",
    width: int = 60,
    min_periods: int = 5,
    default_std: float = 0.2,
    factor: float = 1.5,
) -> DataFrame:
    """Band around a prediction from the rolling sample deviation of its error."""

    def build(x: DataFrame, s: Series) -> DataFrame:
        x = rolling_joined(x.withColumn("_e", F.col(error)), s, ["_e"], [width], ["std"], min_periods)
        count = F.count("_e").over(s.window().rowsBetween(-(width - 1), 0))
        # population to sample deviation
        sample = F.when(count > 1, F.col(f"_e_roll_std_{width}s") * F.sqrt(count / (count - 1)))
        return x.withColumn("err_std", F.coalesce(sample, F.lit(default_std))).drop(
            "_e", f"_e_roll_std_{width}s"
        )

    out = per_series(df, series, lambda part, d: part.frames(d, build, width - 1))
    return out.withColumns(
        {
            "band_upper": F.col(pred) + factor * F.col("err_std"),
            "band_lower": F.col(pred) - factor * F.col("err_std"),
        }
    )
