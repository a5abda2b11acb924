"""Small raw files in the vendor's layout, for end-to-end tests."""

from __future__ import annotations

import csv
import math
import random
from datetime import datetime, timedelta
from pathlib import Path

from wattline.config import HEADERS

COLUMNS = list(HEADERS)


def reading(rng: random.Random, i: int, at: datetime, soc: float) -> dict[str, str]:
    row = {h: f"{rng.uniform(1, 10):.3f}" for h in COLUMNS}
    row.update(
        {
            "Timestamp": at.strftime("%d/%m/%Y %H:%M:%S"),
            "SOC (%)": f"{soc:.3f}",
            "Stack Voltage (V)": f"{400 + 20 * math.sin(i / 90):.3f}",
            "Battery Current (A)": f"{40 * math.sin(i / 60) + rng.uniform(-2, 2):.3f}",
            "Output Power (kW)": f"{16 * math.sin(i / 60):.3f}",
            "Motor Speed (RPM)": f"{1500 + 900 * math.sin(i / 70):.1f}",
            "Avg Battery Temp (°C)": f"{30 + i / 900:.2f}",
            "MCU Enable State": rng.choice(["Enabled", "on", "1", "disabled", "?"]),
            "Battery Status": rng.choice(["ok", "warm"]),
            "Motor Rotation Direction": "fwd",
            "Motor Operation Mode": "drive",
            "Total Running Hours": f"{100 + i // 3600}:{i // 60 % 60:02d}:{i % 60:02d}",
            "Last Trip Hours": "0:10:05",
        }
    )
    return row


def write_day(root: Path, fault_root: Path, day: str, vehicle: str, seed: int, seconds: int = 2400, start_s: int = 36000):
    """About one row a second, with a few doubled, dropped and damaged ones and one long gap."""
    rng = random.Random(seed)
    base = datetime.fromisoformat(day) + timedelta(seconds=start_s)
    rows, soc = [], 90.0 - seed % 5
    for i in range(seconds):
        soc -= 0.02
        if 1200 <= i < 1600 or rng.random() < 0.03:
            continue
        rows.append(reading(rng, i, base + timedelta(seconds=i), soc))
        if rng.random() < 0.05:
            rows.append(reading(rng, i, base + timedelta(seconds=i), soc))
    rows[0]["Timestamp"] = base.strftime("%d/%m/%Y %H:%M:%S")
    rows[50]["Stack Voltage (V)"] = "0"
    rows[60]["Stack Voltage (V)"] = "60"
    rows[70]["Stack Voltage (V)"] = "20"
    rows[80]["Output Power (kW)"] = "n/a"
    rows[90]["Timestamp"] = "broken"
    rows[100], rows[103] = rows[103], rows[100]
    path = root / f"dt={day}" / f"vehicle_id={vehicle}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, COLUMNS)
        out.writeheader()
        out.writerows(rows)
    faults = fault_root / f"dt={day}" / f"vehicle_id={vehicle}.csv"
    faults.parent.mkdir(parents=True, exist_ok=True)
    with faults.open("w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["Activated At", "Fixed At", "Code"])
        stamp = lambda s: (base + timedelta(seconds=s)).strftime("%d/%m/%Y %H:%M:%S")
        out.writerow([stamp(100), stamp(160), " AC-Hall  Failure! "])
        out.writerow([stamp(500), stamp(450), "Inverted"])
        out.writerow([stamp(2300), "", "Total Hardware Failure"])
        out.writerow([stamp(700), stamp(710), "New Code 7"])
    return rows
