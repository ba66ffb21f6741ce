"""Rolling residual scores of a stream, with the last residuals of each meter as state.

A row's score is its residual over the sample deviation of the residuals of itself and the ``rows - 1`` rows before it, in
the order of time, actual and expected value. The state of a meter holds twice that many rows, so that a row that comes
late by at most ``rows - 1`` rows is put in its place and its successors are scored again. A row that comes later than
that is scored among the rows of its own hour that came with it, and changes no other score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000_000
STATE = "at bigint, kwh_actual double, kwh_expected double, told boolean"
OUT = "meter_id string, at bigint, kwh_actual double, kwh_expected double, z_score double"
COLUMNS = ["meter_id", "at", "kwh_actual", "kwh_expected", "z_score"]

#: Time in microseconds, actual, expected, whether it was reported.
Row = tuple[int, float, float, bool]


def scores(rows: list[Row], window: int, first: int = 0) -> np.ndarray:
    """The score of each row from ``first`` on; the first row of all has none."""
    residual = np.abs(np.array([r[1] - r[2] for r in rows]))
    out = np.full(len(rows), np.nan)
    for i in range(max(first, 1), min(window - 1, len(rows))):
        out[i] = residual[i] / (residual[: i + 1].std(ddof=1) + 1e-8)
    start = max(first, window - 1)
    if start < len(rows):
        frames = np.lib.stride_tricks.sliding_window_view(residual, window)[start - window + 1 :]
        out[start:] = residual[start:] / (frames.std(axis=1, ddof=1) + 1e-8)
    return out[first:]


def advance(held: list[Row], new: list[Row], window: int, threshold: float) -> tuple[list[Row], list[tuple[Row, float]]]:
    """The rows to hold from now on, and the rows to report with their scores, in order."""
    back = window - 1
    limit = held[-back][:3] if len(held) == 2 * back else None
    late = sorted(row for row in new if limit is not None and row[:3] < limit)
    new = [row for row in new if limit is None or row[:3] >= limit]
    found: list[tuple[Row, float]] = []
    by_hour: dict[int, list[Row]] = {}
    for row in late:
        by_hour.setdefault(row[0] // HOUR, []).append(row)
    for rows in by_hour.values():
        found += [(row, z) for row, z in zip(rows, scores(rows, window), strict=True) if z > threshold]
    if not new:
        return held, found
    earliest = min(row[:3] for row in new)
    rows = sorted([*held, *new])
    first = next(i for i, row in enumerate(rows) if row[:3] >= earliest)
    for i, z in enumerate(scores(rows, window, first).tolist(), first):
        if z > threshold and not rows[i][3]:
            found.append((rows[i], z))
            rows[i] = (*rows[i][:3], True)
    return rows[-2 * back :], found


class Scorer(StatefulProcessor):
    """One meter's state across batches."""

    def __init__(self, window: int, threshold: float, silence_ms: int | None) -> None:
        self.window, self.threshold, self.silence_ms = window, threshold, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", STATE, self.silence_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(a), float(x), float(y), False) for part in rows for a, x, y in zip(part["at"], part["kwh_actual"], part["kwh_expected"])]
        held = [tuple(row) for row in self.held.get()]
        kept, found = advance(held, new, self.window, self.threshold)
        if kept:
            self.held.put([(int(a), float(x), float(y), bool(told)) for a, x, y, told in kept])
        if found:
            yield pd.DataFrame([(key[0], *row[:3], z) for row, z in found], columns=COLUMNS)

    def close(self) -> None:
        pass


def score_stream(joined: DataFrame, rows: int, threshold: float, silence: str | None = None) -> DataFrame:
    """Rows of ``(time, meter_id, kwh_actual, kwh_expected)`` with a score above the threshold, as a stream.

    Rows of a meter that come in one batch are sorted in one task. Start it with the RocksDB state store.
    """
    silence_ms = None if silence is None else int(pd.Timedelta(silence).total_seconds() * 1000)
    rows_in = joined.filter("kwh_actual IS NOT NULL AND kwh_expected IS NOT NULL").select(
        "meter_id", F.unix_micros("time").alias("at"), "kwh_actual", "kwh_expected"
    )
    found = rows_in.groupBy("meter_id").transformWithStateInPandas(
        Scorer(rows, threshold, silence_ms), OUT, "append", "none" if silence_ms is None else "processingTime"
    )
    return found.withColumn("time", F.timestamp_micros("at")).drop("at")
