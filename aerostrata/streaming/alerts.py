"""Sustained-threshold alerts over a stream of finished windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aerostrata.operators.alerts import ALERT_RULES, AlertRule

OUTPUT = ("station_id string, rule string, severity string, started_at timestamp, "
          "fired_at timestamp, value double")
STATE = "started_at timestamp, last_at timestamp, fired boolean"


def alert_stream(windows: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES,
                 max_gap: str = "5 minutes", silence: int | None = None) -> DataFrame:
    """One row when a rule's condition has held for as long as it asks, once per spell.

    The state per (station, rule) is the running spell.  With `silence` it is forgotten after so
    many milliseconds without a window; a query with such a timeout never runs out of batches, so
    it needs an interval trigger.  A group's rows in one micro-batch are the windows closed since the last
    one, a number bounded by time, not by readings; batches must come in order of time.
    """
    long = windows.select("station_id", "window_start", F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                 F.lit(r.minutes).alias("need"), F.lit(float(r.threshold)).alias("threshold"),
                 F.col(r.column).alias("value"))
        for r in rules
    ])))
    gap = pd.Timedelta(max_gap)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks)).sort_values("window_start", ignore_index=True)
        start, last, fired = state.get if state.exists else (pd.NaT, pd.NaT, False)
        now, on = rows["window_start"], rows["value"] > rows["threshold"]
        before = on.shift(1, fill_value=not pd.isna(start))
        opens = on & ~(before & (now - now.shift(1, fill_value=last) <= gap))
        spell = opens.cumsum()
        since = now.where(opens).groupby(spell).transform("first").where(spell > 0, start)
        # Spell 0 is the one carried over; it fires once, whatever the batch it does so in.
        due = on & (now - since >= pd.to_timedelta(rows["need"], unit="m")) & ~((spell == 0) & fired)
        first = due & ~due.groupby(spell).shift(1, fill_value=False).groupby(spell).cummax()
        if on.iloc[-1]:
            done = bool(due[spell == spell.iloc[-1]].any() or (spell.iloc[-1] == 0 and fired))
            state.update((since.iloc[-1], now.iloc[-1], done))
            if silence:
                state.setTimeoutDuration(silence)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"station_id": key[0], "rule": key[1], "severity": rows["severity"], "started_at": since,
                            "fired_at": now, "value": rows["value"]})[first]

    return long.groupBy("station_id", "rule").applyInPandasWithState(
        step, OUTPUT, STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout if silence else GroupStateTimeout.NoTimeout)
