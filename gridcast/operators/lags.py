"""Lags on any gap-free panel, with windows that never hold a whole series.

A window partitioned by a series alone sends that series to one task.  Here the
time axis is cut into buckets, rows near a bucket edge are copied to the
neighbouring bucket that needs them (the halo), rows are dealt by series and
bucket (also where they were dealt by series before), and the copies are dropped
after the window.  With ``width`` much larger than the longest lag the copies
stay a few percent.

Windows count rows: the axis must have no gap (``fill_days``, ``fill_dates``).
Where day profiles are at hand, ``hour_lags`` takes hourly lags from the day
history instead, on 24 times fewer rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.clock import hour_number

YEAR_OF_HOURS = 8784


class HaloWindow:
    """Bucketed window over a gap-free integer time axis ``step``.

    ``before`` / ``after`` are the largest lag / lead, in steps.  Usage::

        halo = HaloWindow(keys, hour_number(...), width, before=120)
        out = halo.select(df, {"lag3": lambda w: F.lag("x", 3).over(w)})
    """

    def __init__(self, keys: Sequence[str], step: Column, width: int, before: int = 0, after: int = 0):
        self.keys, self.step, self.width = list(keys), step, width
        self.before, self.after = before, after

    def _bucket(self, step: Column) -> Column:
        return F.floor(step / self.width)

    def select(self, df: DataFrame, columns) -> DataFrame:
        step = F.col("_step")
        wide = df.withColumn("_step", self.step)
        spread = F.sequence(self._bucket(step - self.after), self._bucket(step + self.before))
        wide = wide.withColumn("_bucket", F.explode(spread))
        if self.keys:
            wide = wide.repartition(*self.keys, "_bucket")
        w = Window.partitionBy(*self.keys, "_bucket").orderBy("_step")
        wide = wide.withColumns({name: build(w) for name, build in columns.items()})
        wide = wide.filter(F.col("_bucket") == self._bucket(step))
        return wide.drop("_step", "_bucket")


def add_lags(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    lags: Sequence[int],
    step: Column | None = None,
    width: int = YEAR_OF_HOURS,
) -> DataFrame:
    """``<column>_lag<k>``: the value ``k`` steps earlier (hours unless ``step`` says otherwise)."""
    step = hour_number(F.col("date"), F.col("hour")) if step is None else step
    halo = HaloWindow(keys, step, width, before=max(lags))
    return halo.select(
        df,
        {f"{c}_lag{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c in columns for k in lags},
    )
