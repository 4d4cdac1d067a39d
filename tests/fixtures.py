"""Contract files as the upstream extraction writes them."""

from __future__ import annotations

from pathlib import Path

from cyclemart.contract import SOURCE_COLUMNS

HEADER = ",".join(SOURCE_COLUMNS)
BOM = "﻿"


def cycle_row(trial: int, channel: int, label: str, cycle: int, metric: float, burst: bool = True, **cells: str) -> str:
    trough = 100 + 80 * cycle
    values = {name: "0.500000" for name in SOURCE_COLUMNS}
    values.update(
        trial=str(trial), channel_idx=str(channel), channel_label=label, period="80.000000",
        time_ptsym=f"{metric:.6f}", time_rdsym=f"{1 - metric:.6f}",
        sample_peak=str(trough + 40), sample_last_zerox_decay=str(trough - 10), sample_zerox_decay=str(trough + 60),
        sample_zerox_rise=str(trough + 20), sample_last_trough=str(trough), sample_next_trough=str(trough + 80),
        is_burst="True" if burst else "False",
    )
    values.update(cells)
    return ",".join(values[name] for name in SOURCE_COLUMNS)


def feature_file(root: Path, subject: str, region: str, stamp: str, rows: list[str], header: str = HEADER) -> Path:
    folder = root / subject / region
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{subject}_{region}_bycycle_features_{stamp}.csv"
    path.write_text(BOM + "\r\n".join([header, *rows]) + "\r\n", encoding="utf-8")
    return path


def trial_file(root: Path, subject: str, rows: list[tuple[int, int, str]]) -> Path:
    root.mkdir(parents=True, exist_ok=True)
    path = root / f"{subject}_trial_metadata.csv"
    lines = ["subject_id,trial,load_condition,correct", *[f"{subject},{t},{c},{ok}" for t, c, ok in rows]]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path


def recording(root: Path, subject: str, region: str, stamp: str, channels: int = 3, trials: int = 6, cycles: int = 4, shift: float = 0.0) -> Path:
    """A full file: even trials at 0.5, odd ones shifted, with some spread per channel."""
    rows = [
        cycle_row(trial, c, f"L{region}{c}", k, 0.5 + 0.01 * c + 0.001 * k + (shift + 0.002 * c if trial % 2 else 0.0))
        for trial in range(trials) for c in range(channels) for k in range(cycles)
    ]
    return feature_file(root, subject, region, stamp, rows)


def conditions(trials: int = 6) -> list[tuple[int, int, str]]:
    return [(trial, 3 if trial % 2 else 1, "True") for trial in range(trials)]
