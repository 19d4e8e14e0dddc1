"""Persistence forecasts: the last known value carried to every horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.operators import layout, splits
from hourloom.operators.layout import KEYS, LEN, POS, TIME


AGES = {"carry": 0, "carry_day": 24, "carry_two_days": 48}


def persistence_predictions(
    df: DataFrame, index: str = "numerical_aqi", horizons=fixed.HORIZONS, keys=KEYS, ts=TIME
) -> DataFrame:
    """Carried values as named models, in long form with a 60/20/20 split.

    For the value y of a row and a horizon h, the forecast was made h rows earlier; each model
    carries the index from ``age`` rows before that moment.
    """
    depths = sorted({h + age for h in horizons for age in AGES.values()})

    def columns(w):
        return {f"_l{k}": F.lag(index, k).over(w) for k in depths}

    placed = layout.over_series(df, columns, back=depths[-1], keys=keys, ts=ts, keep_position=True)
    split = splits.split_label(F.col(POS), F.col(LEN))
    cells = [
        F.struct(F.lit(m).alias("model"), F.lit(h).alias("horizon"), F.col(f"_l{h + age}").alias("p"))
        for m, age in AGES.items()
        for h in horizons
    ]
    long = placed.select(*keys, ts, split.alias("split"), F.col(index).alias("y"), F.explode(F.array(*cells)).alias("c"))
    return long.select(*keys, ts, "split", "y", "c.model", "c.horizon", "c.p").where("y IS NOT NULL AND p IS NOT NULL")


def persistence_backtest(df: DataFrame, index: str = "numerical_aqi", folds: int = 5, keys=KEYS, ts=TIME) -> DataFrame:
    """Rolling-origin backtest of the persistence forecast: one row per (series, fold, horizon)."""

    def columns(w):
        return {f"_y{h}": F.lead(index, h).over(w) for h in fixed.HORIZONS}

    placed = layout.over_series(df, columns, back=0, ahead=max(fixed.HORIZONS), keys=keys, ts=ts, keep_position=True)
    origins = splits.fold_origins(placed, folds, keys=keys, ts=ts)
    cells = [F.struct(F.lit(h).alias("horizon"), F.col(f"_y{h}").alias("y")) for h in fixed.HORIZONS]
    long = origins.select(*keys, "fold", F.col(index).alias("p"), F.explode(F.array(*cells)).alias("c"))
    return long.select(*keys, "fold", "c.horizon", "c.y", "p").where("y IS NOT NULL AND p IS NOT NULL")
