"""The vehicle schema and the limits the jobs run with. Operators take all of this as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# Bits of the row quality mask.
INTERPOLATED_FAST = 1
FORWARD_FILLED = 2
GAP_INSERTED = 4
SOFT_RANGE_BREACH = 8
HARD_RANGE_BREACH = 16
TIME_ANOMALY = 32
FLATLINE = 64  # reserved, nothing sets it

# Header names of the raw files and their canonical names.
HEADERS = {
    "Timestamp": "timestamp",
    "SOC (%)": "soc_pct",
    "Battery Status": "battery_status",
    "Stack Voltage (V)": "stack_voltage_v",
    "Battery Current (A)": "battery_current_a",
    "Output Power (kW)": "output_power_kw",
    "Charger Current Demand (A)": "charger_current_demand_a",
    "Charger Voltage Demand (V)": "charger_voltage_demand_v",
    "Max Cell Voltage (V)": "max_cell_voltage_v",
    "Min Cell Voltage (V)": "min_cell_voltage_v",
    "Avg Cell Voltage (V)": "avg_cell_voltage_v",
    "Max Battery Temp (°C)": "max_battery_temp_c",
    "Min Battery Temp (°C)": "min_battery_temp_c",
    "Avg Battery Temp (°C)": "avg_battery_temp_c",
    "Motor Torque Limit (Nm)": "motor_torque_limit_nm",
    "Motor Torque Value (Nm)": "motor_torque_value_nm",
    "Motor Speed (RPM)": "motor_speed_rpm",
    "Motor Rotation Direction": "motor_rotation_direction",
    "Motor Operation Mode": "motor_operation_mode",
    "MCU Enable State": "mcu_enable_state",
    "Motor AC Current (A)": "motor_ac_current_a",
    "Motor AC Voltage (V)": "motor_ac_voltage_v",
    "DC Side Voltage (V)": "dc_side_voltage_v",
    "Motor Temperature (°C)": "motor_temperature_c",
    "MCU Temperature (°C)": "mcu_temperature_c",
    "Radiator Temperature (°C)": "radiator_temperature_c",
    "DCDC Pri A MOSFET Temp (°C)": "dcdc_pri_a_mosfet_temp_c",
    "DCDC Sec LS MOSFET Temp (°C)": "dcdc_sec_ls_mosfet_temp_c",
    "DCDC Sec HS MOSFET Temp (°C)": "dcdc_sec_hs_mosfet_temp_c",
    "DCDC Pri C MOSFET Temp (°C)": "dcdc_pri_c_mosfet_temp_c",
    "DCDC Input Voltage (V)": "dcdc_input_voltage_v",
    "DCDC Input Current (A)": "dcdc_input_current_a",
    "DCDC Output Voltage (V)": "dcdc_output_voltage_v",
    "DCDC Output Current (A)": "dcdc_output_current_a",
    "DCDC Overcurrent Count": "dcdc_overcurrent_count",
    "Total Running Hours": "total_running_hours",
    "Last Trip Hours": "last_trip_hours",
    "Total kWh Consumed": "total_kwh_consumed",
    "Last Trip kWh": "last_trip_kwh",
}
FAULT_HEADERS = {"Activated At": "activated_at", "Fixed At": "fixed_at", "Code": "code"}

# Spellings of the enable state.
ENABLE_STATES = {
    "enabled": 1,
    "disabled": 0,
    "on": 1,
    "off": 0,
    "1": 1,
    "0": 0,
    "true": 1,
    "false": 0,
    "1.0": 1,
    "0.0": 0,
}

# How each signal is filled on the regular grid.
FAST_SIGNALS = (
    "stack_voltage_v",
    "battery_current_a",
    "output_power_kw",
    "charger_current_demand_a",
    "charger_voltage_demand_v",
    "max_cell_voltage_v",
    "min_cell_voltage_v",
    "avg_cell_voltage_v",
    "motor_torque_limit_nm",
    "motor_torque_value_nm",
    "motor_speed_rpm",
    "motor_ac_current_a",
    "motor_ac_voltage_v",
    "dc_side_voltage_v",
    "dcdc_input_voltage_v",
    "dcdc_input_current_a",
    "dcdc_output_voltage_v",
    "dcdc_output_current_a",
)
SLOW_SIGNALS = (
    "max_battery_temp_c",
    "min_battery_temp_c",
    "avg_battery_temp_c",
    "motor_temperature_c",
    "mcu_temperature_c",
    "radiator_temperature_c",
    "dcdc_pri_a_mosfet_temp_c",
    "dcdc_sec_ls_mosfet_temp_c",
    "dcdc_sec_hs_mosfet_temp_c",
    "dcdc_pri_c_mosfet_temp_c",
    "soc_pct",
)
STATUS_SIGNALS = (
    "battery_status",
    "motor_rotation_direction",
    "motor_operation_mode",
    "mcu_enable_state",
)
COUNTER_SIGNALS = (
    "dcdc_overcurrent_count",
    "total_running_hours_s",
    "last_trip_hours_s",
    "total_kwh_consumed",
    "last_trip_kwh",
)
NUMERIC_SIGNALS = FAST_SIGNALS + SLOW_SIGNALS + COUNTER_SIGNALS
DURATION_COLUMNS = ("total_running_hours", "last_trip_hours")
ZERO_IS_MISSING = ("stack_voltage_v",)
REQUIRED_COLUMNS = ("timestamp", "vehicle_id", "soc_pct")

# Fault codes that always get a flag column.
KNOWN_FAULT_CODES = (
    "busbar_undervoltage_fault",
    "bus_overvoltage_fault",
    "hardware_overvoltage_fault",
    "total_hardware_failure",
    "ac_hall_failure",
    "module_over_temperature_warning",
    "temperature_difference_failure",
    "low_voltage_undervoltage_fault",
    "software_overcurrent_fault",
)

# Signals the feature rows are built from.
BASE_SIGNALS = (
    "soc_pct",
    "stack_voltage_v",
    "battery_current_a",
    "output_power_kw",
    "motor_speed_rpm",
    "dc_side_voltage_v",
    "avg_battery_temp_c",
    "max_battery_temp_c",
    "min_battery_temp_c",
    "avg_cell_voltage_v",
    "max_cell_voltage_v",
    "min_cell_voltage_v",
    "motor_temperature_c",
    "mcu_temperature_c",
    "radiator_temperature_c",
    "total_kwh_consumed",
    "last_trip_kwh",
)

# Inputs of the five-minute state-of-charge forecast.
FORECAST_FEATURES = (
    "soc_pct",
    "soc_pct_lag_60s",
    "soc_pct_lag_300s",
    "soc_pct_lag_600s",
    "soc_pct_roll_mean_60s",
    "soc_pct_roll_mean_300s",
    "soc_pct_roll_std_60s",
    "soc_pct_roll_std_300s",
    "battery_current_a",
    "battery_current_a_lag_60s",
    "battery_current_a_lag_300s",
    "battery_current_a_roll_mean_30s",
    "battery_current_a_roll_mean_300s",
    "battery_current_a_roll_std_60s",
    "battery_current_a_roll_max_60s",
    "battery_current_a_roll_min_60s",
    "stack_voltage_v",
    "stack_voltage_v_lag_60s",
    "stack_voltage_v_lag_300s",
    "stack_voltage_v_roll_mean_60s",
    "stack_voltage_v_roll_mean_300s",
    "stack_voltage_v_roll_std_60s",
    "max_cell_voltage_v",
    "min_cell_voltage_v",
    "cell_voltage_delta_v",
    "cell_voltage_delta_norm",
    "max_cell_voltage_v_roll_mean_60s",
    "min_cell_voltage_v_roll_mean_60s",
    "output_power_kw",
    "output_power_kw_lag_60s",
    "output_power_kw_lag_300s",
    "output_power_kw_roll_mean_60s",
    "output_power_kw_roll_mean_300s",
    "output_power_kw_roll_std_60s",
    "output_power_kw_roll_max_60s",
    "elec_power_kw_proxy",
    "motor_speed_rpm",
    "motor_speed_rpm_lag_60s",
    "motor_speed_rpm_roll_mean_60s",
    "motor_speed_rpm_roll_mean_300s",
    "motor_speed_rpm_roll_std_60s",
    "motor_speed_rpm_roll_max_60s",
    "avg_battery_temp_c",
    "avg_battery_temp_c_lag_60s",
    "avg_battery_temp_c_lag_300s",
    "avg_battery_temp_c_roll_mean_300s",
    "avg_battery_temp_c_roll_std_300s",
    "battery_temp_delta_c",
    "battery_temp_delta_norm",
    "motor_temperature_c",
    "motor_temperature_c_lag_300s",
    "motor_temperature_c_roll_mean_300s",
    "motor_temperature_c_roll_std_60s",
    "total_kwh_consumed",
    "total_kwh_consumed_lag_60s",
    "total_kwh_consumed_lag_300s",
    "fault_any",
    "power_proxy_error_kw",
    "power_proxy_ratio",
    "is_charging_current",
    "is_parked_charging",
)
FORECAST_TARGET = "y_soc_t_plus_300s"


@dataclass(frozen=True)
class Range:
    """Inclusive bounds: outside `soft` a reading is flagged, outside `hard` it is also nulled."""

    soft: tuple[float, float] | None = None
    hard: tuple[float, float] | None = None


# Range limits of the checked signals.
RANGES = {
    "soc_pct": Range(soft=(0, 100), hard=(-1, 101)),
    "stack_voltage_v": Range(soft=(100, 1000), hard=(50, 1200)),
    "battery_current_a": Range(soft=(-2000, 2000), hard=(-5000, 5000)),
    "output_power_kw": Range(soft=(-500, 500), hard=(-1000, 1000)),
    "avg_battery_temp_c": Range(soft=(-10, 70), hard=(-30, 90)),
}

# Day-first formats the time parser tries, in order; `d`, `M` and `H` also take two digits.
TIME_FORMATS = (
    "d/M/yyyy H:mm:ss[.SSSSSS][.SSS]",
    "d-M-yyyy H:mm:ss[.SSSSSS][.SSS]",
    "d.M.yyyy H:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "d/M/yyyy H:mm",
    "d-M-yyyy H:mm",
    "yyyy-MM-dd HH:mm",
    "d/M/yyyy",
    "d-M-yyyy",
    "yyyy-MM-dd",
    "yyyy/MM/dd H:mm:ss[.SSSSSS][.SSS]",
    "yyyy/MM/dd H:mm",
    "d/M/yyyy h:mm:ss a",
    "d/M/yyyy h:mm a",
    "d MMM yyyy H:mm:ss",
    "d-MMM-yyyy H:mm:ss",
    "d/M/yy H:mm:ss",
    "d/M/yy H:mm",
)


@dataclass(frozen=True)
class ResampleConfig:
    step_s: int = 1
    fast_limit_s: int = 5
    slow_limit_s: int = 60
    status_limit_s: int = 600


@dataclass(frozen=True)
class TripConfig:
    gap_break: int = 300
    min_rows: int = 60


@dataclass(frozen=True)
class GoldConfig:
    signals: tuple[str, ...] = BASE_SIGNALS
    windows: tuple[int, ...] = (30, 60, 300, 600)
    aggs: tuple[str, ...] = ("mean", "std", "min", "max")
    lags: tuple[int, ...] = (60, 300, 600)
    target: str = FORECAST_TARGET
    target_source: str = "soc_pct"
    horizon: int = 300
    max_jump: float = 25.0
    drop_mask: int = HARD_RANGE_BREACH | TIME_ANOMALY
    trip_min_rows: int = 60
    daily_min_rows: int = 60


@dataclass(frozen=True)
class Thresholds:
    mae_excellent: float = 0.5
    mae_acceptable: float = 1.5
    mae_investigate: float = 2.0
    gap_ok: float = 0.5
    psi_monitor: float = 0.1
    psi_alert: float = 0.2
    ks_pvalue: float = 0.05
    mean_shift_pct: float = 10.0


@dataclass(frozen=True)
class ForecastConfig:
    task: str = "soc_forecast"
    features: tuple[str, ...] = FORECAST_FEATURES
    target: str = FORECAST_TARGET
    drop_mask: int = GAP_INSERTED | HARD_RANGE_BREACH | TIME_ANOMALY
    micro_min_rows: int = 60
    micro_min_range: float = 3.0
    max_iter: int = 800
    max_depth: int = 6
    patience: int = 30
    step_size: float = 0.05
    subsample: float = 0.8
    column_share: float = 0.8
    min_instances: int = 10
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 256
    seed: int = 42
    thresholds: Thresholds = field(default_factory=Thresholds)
