"""Load attributable to weather: actual minus the load at a neutral temperature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.regression import score

# Fixed value: at 16 degrees neither heating nor cooling is used.
NEUTRAL_TEMPERATURE = 16.0


def weather_columns(df: DataFrame, token: str = "temperature") -> list[str]:
    """Columns whose first name token is ``token``."""
    return [c for c in df.columns if c.split("_")[0] == token]


def neutral_weather(df: DataFrame, value: float = NEUTRAL_TEMPERATURE, token: str = "temperature") -> DataFrame:
    """All weather columns set to one reference value."""
    return df.withColumns({c: F.lit(float(value)) for c in weather_columns(df, token)})


def counterfactual(
    df: DataFrame, model: DataFrame, keys: Sequence[str], x: Sequence[str], log: bool = True,
    value: float = NEUTRAL_TEMPERATURE, out: str = "neutral_load",
) -> DataFrame:
    """The model's load of every row under neutral weather; the weather columns are replaced."""
    return score(neutral_weather(df, value), model, keys, x, log, out)


def climate_part(actual: Column, neutral: Column) -> Column:
    """Weather-driven part of the load, never negative; null where either is unknown."""
    part = actual - neutral
    return F.when(part < 0, 0.0).otherwise(part)
