"""Search over ranges of settings by successive halving, and tuning of the best models."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.models import regressors
from hourloom.operators import metrics
from hourloom.operators.layout import KEYS, TIME

TRIALS = "round int, trial int, share double, setting string, rmse double"


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rng: random.Random):
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class LogUniform:
    """Every order of magnitude is as likely as any other."""

    low: float
    high: float

    def draw(self, rng: random.Random):
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class Integer:
    """Whole numbers from low to high, without high."""

    low: int
    high: int

    def draw(self, rng: random.Random):
        return rng.randrange(self.low, self.high)


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


def draws(space: dict, n: int, seed: int = 42) -> list[dict]:
    """n settings, the same for the same seed, and the first m of them the same for any n >= m."""
    rng = random.Random(seed)
    return [{name: one.draw(rng) for name, one in sorted(space.items())} for _ in range(n)]


def row_share(df: DataFrame, share: float, keys=KEYS, ts: str = TIME, seed: int = 42) -> DataFrame:
    """All rows but the train rows, of which a share is kept by a hash of the row's key: smaller shares lie in larger."""
    if share >= 1:
        return df
    place = F.pmod(F.xxhash64(F.lit(seed), *keys, ts), F.lit(1_000_000)) < F.lit(round(share * 1_000_000))
    return df.where((F.col("split") != "train") | place)


def successive_halving(
    df: DataFrame,
    features: list[str],
    label: str,
    make: Callable,
    settings: list[dict],
    factor: int = 3,
    least: float = 0.1,
    parallel: int = 4,
    keys=KEYS,
    ts: str = TIME,
):
    """The best setting by validation RMSE: all are fitted on a small share of the train rows, the best part of them on a
    larger one, until the last ones are fitted on all rows. The fits of a round run side by side.

    ``make(label, **setting)`` builds the estimator. Returns (model, setting, trials); ties go to the earlier draw.
    """
    if not settings:
        raise ValueError("no settings to try")
    rounds = max(0, math.ceil(math.log(len(settings), factor) - 1e-9))
    left, told, models, best = list(range(len(settings))), [], {}, None
    for r in range(rounds + 1):
        share = 1.0 if r == rounds else max(least, float(factor) ** (r - rounds))
        rows = row_share(df, share, keys, ts)

        def error(i: int) -> float:
            models[i] = regressors.train_one(make(label, **settings[i]), rows, features)
            return float(regressors.validation_rmse(models[i], df, label))

        with ThreadPool(min(parallel, len(left))) as pool:
            found = dict(zip(left, pool.map(error, left)))
        told += [(r, i, share, str(sorted(settings[i].items())), found[i]) for i in left]
        ranked = sorted(left, key=lambda i: (found[i], i))
        best = ranked[0]
        left = ranked[: max(1, len(ranked) // factor)]
    return models[best], settings[best], df.sparkSession.createDataFrame(told, TRIALS)


def tune_top(
    df: DataFrame,
    features: list[str],
    label: str,
    predictions: DataFrame,
    spaces: dict[str, tuple[Callable, dict]],
    k: int = 3,
    n: int = 9,
    seed: int = 42,
    **halving,
):
    """Search around the k best models of a leaderboard. ``spaces`` gives for each model (make, ranges).

    Returns (models by name, settings by name, trials with the model's name).
    """
    top = metrics.top_models(regressors.leaderboard(predictions), k).select("model").collect()
    models, chosen, trials = {}, {}, None
    for row in top:
        make, space = spaces[row.model]
        model, setting, told = successive_halving(df, features, label, make, draws(space, n, seed), **halving)
        models[row.model], chosen[row.model] = model, setting
        told = told.withColumn("model", F.lit(row.model))
        trials = told if trials is None else trials.unionByName(told)
    return models, chosen, trials
