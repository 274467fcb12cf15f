"""Polynomial smoothing and the daily-to-hourly temperature profile."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.clock import hour_number
from gridcast.operators.lags import YEAR_OF_HOURS, HaloWindow

# Hourly temperature = daily temperature + intercept + sum of these terms.
PROFILE_INTERCEPT = -4.750991
PROFILE_TERMS = {
    "hour": 0.434547,
    "hour^2": -0.007320,
    "hour^3": -0.000415,
    "month": 0.354375,
    "sun_down": 0.500070,
    "sun_rise": -0.511187,
    "sun_last": -0.310402,
    "day_of_year": -0.010265,
}


def savgol_weights(window: int = 7, degree: int = 3) -> np.ndarray:
    """Least-squares weights: row ``r`` gives the fitted value at position ``r`` of a window."""
    x = np.arange(window) - window // 2
    basis = np.vander(x, degree + 1).astype(float)
    return basis @ np.linalg.pinv(basis)


def smooth_savgol(
    df: DataFrame, keys: Sequence[str], column: str, out: str = "smooth",
    window: int = 7, degree: int = 3, step: Column | None = None, width: int = YEAR_OF_HOURS,
) -> DataFrame:
    """Savitzky-Golay smoothing of a gap-free series.

    Inner rows take the centre row of the weights; the first and last
    ``window // 2`` rows of a series use the fit of its first and last window.
    A series shorter than the window gives null.
    """
    step = hour_number(F.col("date"), F.col("hour")) if step is None else step
    half = window // 2
    weights = savgol_weights(window, degree)
    halo = HaloWindow(keys, step, width, before=window, after=window)

    def shifted(w, k):
        return F.lag(column, -k).over(w) if k < 0 else F.lead(column, k).over(w) if k else F.col(column)

    shifts = range(-(window - 1), window)
    names = {k: f"_s{k + window}" for k in shifts}
    columns = {names[k]: (lambda w, k=k: shifted(w, k)) for k in shifts}
    columns |= {f"_b{k}": (lambda w, k=k: F.lag("_step", k).over(w).isNull()) for k in range(1, half + 1)}
    columns |= {f"_a{k}": (lambda w, k=k: F.lead("_step", k).over(w).isNull()) for k in range(1, half + 1)}
    wide = halo.select(df, columns)

    def fitted(row):  # value at position ``row`` of the window that starts ``row`` rows earlier
        return " + ".join(f"{names[j - row]} * {float(weights[row][j])!r}D" for j in range(window))

    cases = []
    for r in range(half):  # r rows before this one, or r rows after it
        cases += [f"WHEN _b{r + 1} THEN {fitted(r)}", f"WHEN _a{r + 1} THEN {fitted(window - 1 - r)}"]
    value = f"CASE {' '.join(cases)} ELSE {fitted(half)} END"
    return wide.selectExpr(*[f"`{c}`" for c in df.columns], f"{value} AS `{out}`")


def temperature_profile(
    temperature: Column, hour: Column, month: Column, sun_down: Column, sun_rise: Column,
    sun_last: Column, day_of_year: Column,
) -> Column:
    """Hourly temperature from the daily one: cubic in the hour, linear in season and sun."""
    values = {
        "hour": hour, "hour^2": F.pow(hour, 2), "hour^3": F.pow(hour, 3), "month": month,
        "sun_down": sun_down, "sun_rise": sun_rise, "sun_last": sun_last, "day_of_year": day_of_year,
    }
    total = temperature + PROFILE_INTERCEPT
    for name, coefficient in PROFILE_TERMS.items():
        total = total + values[name] * coefficient
    return total
