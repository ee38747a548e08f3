"""Month-by-month restatement as a stream: facts arrive in month files, first values stay in the state.

The batch form (operators.accounts.restatement) needs all months at hand; this one keeps a state per key, so each month
is read once. Completeness comes from a manifest of months, not from a watermark.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def restated_stream(facts: DataFrame, key: list[str], value: str) -> DataFrame:
    """A stream of key columns, n (facts so far) and differs (a later value isn't the first), a row per key and micro-batch."""
    names = ", ".join(f"{k} string" for k in key)

    def update(k: tuple, frames, state: GroupState):
        first, n, differs = state.get if state.exists else (None, 0, False)
        for frame in frames:
            for v in frame[value]:
                first = v if n == 0 else first
                n, differs = n + 1, differs or v != first
        state.update((first, n, differs))
        yield pd.DataFrame([(*k, n, differs)], columns=[*key, "n", "differs"])

    return facts.groupBy(*key).applyInPandasWithState(update, f"{names}, n long, differs boolean", "first string, n long, differs boolean", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, at: str, kind: str, value: str, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Event counts and sums per window and kind; events later than `late` are left out."""
    from pyspark.sql import functions as F

    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")
