"""Row-position splits, targets, folds and history windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions import fixed
from hourloom.operators import layout
from hourloom.operators.layout import KEYS, LEN, POS, TIME


def _placed(df, keys, ts):
    return df if POS in df.columns else layout.with_position(df, keys, ts)


def split_label(pos: Column, length: Column, train: float = 0.6, validation: float = 0.2) -> Column:
    """train / validation / test by position; sizes are truncated to whole rows."""
    n_train = F.floor(length * F.lit(float(train)))
    n_both = n_train + F.floor(length * F.lit(float(validation)))
    return F.when(pos <= n_train, "train").when(pos <= n_both, "validation").otherwise("test")


def temporal_split(df: DataFrame, train=0.6, validation=0.2, keys=KEYS, ts=TIME) -> DataFrame:
    """Label the rows of each series; ``validation=0`` gives a two-way split."""
    out = _placed(df, keys, ts)
    return out.withColumn("split", split_label(F.col(POS), F.col(LEN), train, validation)).drop(POS, LEN)


def future_targets(df: DataFrame, index: str = "numerical_aqi", horizons=fixed.HORIZONS, keys=KEYS, ts=TIME):
    """``target_aqi_{h}h``: the index h rows later; the index itself is then dropped."""
    out = layout.over_series(
        df,
        lambda w: {f"target_aqi_{h}h": F.lead(index, h).over(w) for h in horizons},
        back=0,
        ahead=max(horizons),
        keys=keys,
        ts=ts,
        keep_position=True,
    )
    return out.drop(index)


def tail_cuts(placed: DataFrame, targets=fixed.TARGETS, keys=KEYS) -> DataFrame:
    """Per series the position of the last row at which every target still has a later value.

    A target that never occurs gives position 1; nothing is cut then.
    """
    last = [F.coalesce(F.max(F.when(F.col(t).isNotNull(), F.col(POS))), F.lit(1)) for t in targets]
    return placed.groupBy(*keys).agg((F.least(*last) if len(last) > 1 else last[0]).alias("_cut"))


def trim_tail(
    df: DataFrame, targets=fixed.TARGETS, keys=KEYS, ts=TIME, cuts: DataFrame | None = None
) -> DataFrame:
    """Cut each series after its ``tail_cuts`` position."""
    placed = _placed(df, keys, ts)
    cuts = cuts if cuts is not None else tail_cuts(placed, targets, keys)
    return placed.join(cuts, list(keys)).where((F.col("_cut") <= 1) | (F.col(POS) <= F.col("_cut"))).drop("_cut")


def rolling_origin_folds(df: DataFrame, folds: int, min_rows: int = 0, keys=KEYS, ts=TIME) -> DataFrame:
    """(fold, rows up to its origin) for expanding origins; short folds are skipped.

    Each row is copied to the folds that contain it: ``folds`` copies at most.
    """
    placed = _placed(df, keys, ts)
    size = F.floor(F.col(LEN) / F.lit(folds + 1))
    numbers = F.sequence(F.lit(1), F.lit(folds))
    out = placed.withColumn("fold", F.explode(numbers)).withColumn("origin", F.col("fold") * size)
    return out.where((F.col(POS) <= F.col("origin")) & (F.col("origin") > min_rows))


def fold_origins(df: DataFrame, folds: int, min_rows: int = 0, keys=KEYS, ts=TIME) -> DataFrame:
    """Only the last row of each fold: the row a backtest predicts from."""
    placed = _placed(df, keys, ts)
    size = F.floor(F.col(LEN) / F.lit(folds + 1))
    fold = F.try_divide(F.col(POS), size)
    at_origin = (size > 0) & (F.pmod(F.col(POS), F.greatest(size, F.lit(1))) == 0) & (fold <= folds)
    return placed.where(at_origin & (F.col(POS) > min_rows)).withColumn("fold", fold.cast("int"))


def latest_rows(df: DataFrame, n: int = 1, keys=KEYS, ts=TIME) -> DataFrame:
    """Last n rows of each series; map tasks drop all but n rows per series first."""
    from hourloom.operators.profiles import top_per_group

    return top_per_group(df, n, keys, [F.col(ts).desc()]).drop("rank")


def sequence_windows(
    df: DataFrame, features: list[str], label: str, length: int, variant: str = "label_at_end", keys=KEYS, ts=TIME
) -> DataFrame:
    """Fixed-length history ``seq`` (oldest first) with its label.

    label_at_end: windows end at each row from ``length`` on, label of that row.
    label_next: label of the row after the window.
    drop_last: label at the end, the final window left out.
    """
    ahead = 1 if variant == "label_next" else 0

    def columns(w):
        body = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
        history = F.collect_list(body).over(w.rowsBetween(-(length - 1), 0))
        target = F.lead(label, 1).over(w) if ahead else F.col(label)
        return {"seq": history, "label": target}

    out = layout.over_series(df, columns, back=length - 1, ahead=ahead, keys=keys, ts=ts, keep_position=True)
    end = F.col(LEN) - (0 if variant == "label_at_end" else 1)
    kept = out.where((F.col(POS) >= length) & (F.col(POS) <= end))
    return kept.select(*keys, ts, POS, "seq", "label")


def contiguous_folds(df: DataFrame, folds: int, keys=KEYS, ts=TIME) -> DataFrame:
    """Unshuffled fold number 0..folds-1 by position; earlier folds take the remainder."""
    placed = _placed(df, keys, ts)
    size = F.floor(F.col(LEN) / F.lit(folds))
    extra = F.col(LEN) - size * folds
    at = F.col(POS) - 1
    split = extra * (size + 1)
    fold = F.when(at < split, F.floor(at / (size + 1))).otherwise(extra + F.floor((at - split) / F.greatest(size, F.lit(1))))
    return placed.withColumn("fold", fold.cast("int"))
