"""Physics, cleaning and metric expressions. Each returns a Column; none touches rows outside its own."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.config import ENABLE_STATES, HARD_RANGE_BREACH, SOFT_RANGE_BREACH, TIME_FORMATS, Range


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- ratios and physics


def clip(value: Column, lo: float, hi: float) -> Column:
    """NULL stays NULL (greatest and least alone would return the bound)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(float(hi))), F.lit(float(lo))))


def safe_ratio(num: Column | str, den: Column | str, min_den: float = 1e-3, bound: float | None = 10.0) -> Column:
    """num / |den|, NULL where |den| is below `min_den`, clipped. The sign of `den` is not used."""
    size = F.abs(col(den))
    ratio = F.when(size >= min_den, col(num) / size)
    return ratio if bound is None else clip(ratio, -bound, bound)


def physics(df: DataFrame) -> DataFrame:
    """Add every derived quantity whose inputs the table has."""
    have = set(df.columns)
    made: dict[str, Column] = {}

    def add(name: str, needs: Iterable[str], expr: Column) -> None:
        if set(needs) <= have:
            made[name] = expr
            have.add(name)

    def value(name: str) -> Column:
        return made.get(name, F.col(name)) if name not in df.columns else F.col(name)

    kilo = 1000.0
    add(
        "elec_power_kw_proxy",
        ["stack_voltage_v", "battery_current_a"],
        F.col("stack_voltage_v") * F.col("battery_current_a") / kilo,
    )
    power = value("elec_power_kw_proxy")
    pair = ["output_power_kw", "elec_power_kw_proxy"]
    add("power_proxy_error_kw", pair, F.col("output_power_kw") - power)
    add("power_proxy_ratio", pair, safe_ratio("output_power_kw", power, 0.5))

    for spread, norm, hi, lo, mean in (
        ("cell_voltage_delta_v", "cell_voltage_delta_norm", "max_cell_voltage_v", "min_cell_voltage_v", "avg_cell_voltage_v"),
        ("battery_temp_delta_c", "battery_temp_delta_norm", "max_battery_temp_c", "min_battery_temp_c", "avg_battery_temp_c"),
    ):
        add(spread, [hi, lo], F.col(hi) - F.col(lo))
        add(norm, [spread, mean], safe_ratio(value(spread), mean, 1e-3))

    shaft = F.col("motor_torque_value_nm") * (F.col("motor_speed_rpm") * (2.0 * math.pi / 60.0)) / kilo
    add("mech_power_kw_proxy", ["motor_torque_value_nm", "motor_speed_rpm"], shaft)
    add("eff_proxy", ["mech_power_kw_proxy", "elec_power_kw_proxy"], safe_ratio(shaft, power, 0.5))

    for name, hot in (
        ("motor_minus_radiator_temp_c", "motor_temperature_c"),
        ("mcu_minus_radiator_temp_c", "mcu_temperature_c"),
    ):
        add(name, [hot, "radiator_temperature_c"], F.col(hot) - F.col("radiator_temperature_c"))

    for side in ("input", "output"):
        volts, amps = f"dcdc_{side}_voltage_v", f"dcdc_{side}_current_a"
        add(f"dcdc_{side}_kw_proxy", [volts, amps], F.col(volts) * F.col(amps) / kilo)
    add(
        "dcdc_eff_proxy",
        ["dcdc_input_kw_proxy", "dcdc_output_kw_proxy"],
        safe_ratio(value("dcdc_output_kw_proxy"), value("dcdc_input_kw_proxy"), 0.1),
    )
    return df.withColumns(made) if made else df


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def charging_flags(current: str = "battery_current_a", speed: str = "motor_speed_rpm") -> dict[str, Column]:
    return {
        "is_charging_current": flag(F.col(current) > 0),
        "is_parked_charging": flag((F.col(current) > 5) & (F.abs(F.col(speed)) < 50)),
    }


def quiet_flag(
    speed: str = "motor_speed_rpm", power: str = "output_power_kw", current: str = "battery_current_a"
) -> Column:
    return flag(
        (F.abs(F.col(speed)) < 50) & (F.abs(F.col(power)) < 0.2) & (F.abs(F.col(current)) < 1.0)
    )


# ---- text, times, categories


def seconds_of(text: Column | str) -> Column:
    """`HH:MM:SS` as seconds; hours may pass 24; anything else is NULL."""
    parts = F.split(F.trim(col(text)), ":")
    h, m, s = (F.trim(F.get(parts, F.lit(i))).try_cast("long").cast("double") for i in range(3))
    return F.when(F.size(parts) == 3, h * 3600 + m * 60 + s)


def category(text: Column | str, mapping: Mapping[str, int] = ENABLE_STATES) -> Column:
    """Trimmed, lower-cased text looked up in a fixed mapping; unknown spellings are NULL."""
    word = F.lower(F.trim(col(text).cast("string")))
    out = None
    for target in sorted(set(mapping.values())):
        spellings = [k for k, v in mapping.items() if v == target]
        out = (F if out is None else out).when(word.isin(*spellings), F.lit(target))
    return out


def parse_time(text: Column | str, formats: Iterable[str] = TIME_FORMATS) -> Column:
    """Day-first timestamp in UTC from the first format that fits; NULL if none does."""
    word = F.trim(col(text).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(word, F.lit(f)) for f in formats])


def number(text: Column | str) -> Column:
    """Text or number as a double; bad text and NaN are NULL."""
    value = col(text).try_cast("double")
    return F.when(~F.isnan(value), value)


def fault_code(text: Column | str) -> Column:
    """Lower case, runs of other characters as one underscore, none at the ends."""
    word = F.regexp_replace(F.lower(F.trim(col(text).cast("string"))), "[^a-z0-9]+", "_")
    return F.regexp_replace(word, "^_+|_+$", "")


# ---- quality bits


def has_bits(mask: Column | str, bits: int) -> Column:
    return F.coalesce(col(mask), F.lit(0)).bitwiseAND(bits) != 0


def without_bits(df: DataFrame, mask: str, bits: int) -> DataFrame:
    return df.where(~has_bits(mask, bits))


def outside(value: Column, bounds: tuple[float, float] | None) -> Column:
    """True where a reading is present and out of the inclusive bounds."""
    if bounds is None:
        return F.lit(False)
    return F.coalesce((value < bounds[0]) | (value > bounds[1]), F.lit(False))


def check_ranges(df: DataFrame, ranges: Mapping[str, Range], mask: str = "quality_flag") -> DataFrame:
    """Set the soft and hard bits and null hard breaches, in one projection."""
    bits = F.coalesce(F.col(mask), F.lit(0))
    kept = {}
    for name, limits in ranges.items():
        if name not in df.columns:
            continue
        value = F.col(name)
        soft, hard = outside(value, limits.soft), outside(value, limits.hard)
        bits = bits.bitwiseOR(F.when(soft, F.lit(SOFT_RANGE_BREACH)).otherwise(F.lit(0)))
        bits = bits.bitwiseOR(F.when(hard, F.lit(HARD_RANGE_BREACH)).otherwise(F.lit(0)))
        kept[name] = F.when(~hard, value)
    return df.withColumns({**kept, mask: bits})


# ---- table shape


def require(df: DataFrame, names: Iterable[str], where: str = "table") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{where} lacks the columns {missing}")


def existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Those of the wanted columns that exist, without repeats."""
    return df.select(*[n for n in dict.fromkeys(names) if n in df.columns])


def add_missing(df: DataFrame, names: Iterable[str], fill: object = None, kind: str = "double") -> DataFrame:
    absent = {n: F.lit(fill).cast(kind) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def align_columns(df: DataFrame, names: Iterable[str], fill: float = 0.0) -> DataFrame:
    """Exactly the listed columns as doubles, absent ones and NULLs filled."""
    return df.select(
        *[
            F.coalesce(F.col(n).cast("double"), F.lit(fill)).alias(n) if n in df.columns else F.lit(fill).alias(n)
            for n in names
        ]
    )


def truthy(c: Column | str) -> Column:
    """NULL and 0 are false."""
    return F.coalesce(col(c).cast("int"), F.lit(0)) != 0


def ordered_columns(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """The given columns first, the rest by name."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *sorted(set(df.columns) - set(head)))


def choose_features(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Numeric columns that are not keys, labels or leakage, by name."""
    out = set(exclude)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in out]
    if not names:
        raise ValueError("no numeric feature columns")
    return sorted(names)
