"""Load features anchored to a forecast origin.

The forecast for a day is issued ``offset`` hours before its 00:00 (15 hours:
09:00 the day before).  All 24 hours of the day see the same load history, that
of the origin, so the features are columns of the day's profile row and cost no
join.  A forecast ``j`` days ahead uses the features of its issue day: horizons
are a column and not a loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.profiles import by_date, days_needed, history, hours_before

# Load lags, in hours before the forecast origin.
LOAD_LAGS = (
    0, 1, 2, 3, 4, 5, 6, 21, 22, 23, 24, 25, 26, 48, 49, 50, 72, 73, 75,
    96, 97, 98, 119, 120, 121, 167, 168, 169, 335, 336, 337,
)

# The next-day forecast is issued 15 hours before midnight;
# trailing statistics cover one and two days.
OFFSET = 15
STAT_HOURS = (24, 48)


def _trailing(past: str, offset: int, hours: int) -> str:
    """The last ``hours`` values up to the origin; null unless all are known."""
    frame = f"slice({past}, -{24 + offset + hours - 1}, {hours})"
    full = f"size({frame}) = {hours} AND forall({frame}, x -> x IS NOT NULL)"
    return f"CASE WHEN {full} THEN {frame} END"


def add_origin_lags(
    profiles: DataFrame,
    keys: Sequence[str],
    column: str = "load",
    lags: Sequence[int] = LOAD_LAGS,
    offset: int = OFFSET,
    stats: Sequence[int] = STAT_HOURS,
) -> DataFrame:
    """``lag<i>``, and ``min/max/mean_<n>h`` over the ``n`` hours up to the origin.

    ``profiles`` must have gap-free days (see ``fill_days``).
    """
    reach = offset + max([*lags, *[n - 1 for n in stats]])
    wide = profiles.withColumn("_past", history(column, keys, days_needed(reach)))
    wide = wide.selectExpr("*", *[f"{_trailing('_past', offset, n)} AS _last{n}" for n in stats])
    out = [f"{hours_before('_past', offset + i)} AS lag{i}" for i in lags]
    for n in stats:
        total = f"aggregate(_last{n}, 0D, (acc, x) -> acc + x)"
        out += [f"array_min(_last{n}) AS min_{n}h", f"array_max(_last{n}) AS max_{n}h", f"{total} / {n} AS mean_{n}h"]
    return wide.selectExpr(*[f"`{c}`" for c in profiles.columns], *out)


def spread_horizons(
    profiles: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = ("load",),
    horizons: int = 14,
) -> DataFrame:
    """One row per issue day and ``horizon`` 1..n with the profile of the target day.

    On the input, ``date`` is the issue day (horizon 1 targets that very day, as
    seen from ``offset`` hours before it).  On the output ``issue_date`` is the
    issue day and ``date`` the target; ``columns`` belong to the target, all
    other columns to the issue day.
    """
    ahead = by_date(keys).rowsBetween(0, horizons - 1)
    day = F.struct(F.col("date"), *[F.col(c) for c in columns])
    rest = [c for c in profiles.columns if c not in (*keys, "date", *columns)]
    wide = profiles.withColumn("_ahead", F.collect_list(day).over(ahead))
    wide = wide.select(*keys, F.col("date").alias("issue_date"), *rest, F.posexplode("_ahead").alias("_pos", "_target"))
    return wide.select(
        *keys, "issue_date", (F.col("_pos") + 1).alias("horizon"),
        F.col("_target.date").alias("date"), *[F.col(f"_target.{c}").alias(c) for c in columns], *rest,
    )
