"""PL4: from hourly rows to the training table, and the final selected table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions import air, clock, fixed
from hourloom.operators import fill, guards, layout, running, stats
from hourloom.plans import features, index
from hourloom.session import cut_lineage

CLIP_LIMITS = {"temperature": (-10.0, 50.0), "numerical_aqi": (0.0, 500.0)}


def clean_sources(df: DataFrame, keys=layout.KEYS, ts=layout.TIME) -> DataFrame:
    """Positioned source rows with, beside each raw column c, its filled form ``_clean_c``.

    Written twice, both narrow: the positioned rows, which the medians and the fills read, and
    the result, which the quartile passes and the feature pass read. The several
    hundred feature columns never have to be stored in between.
    """
    placed = cut_lineage(layout.with_position(df, keys, ts), "placed")
    sources = [c for c in df.columns if c not in (*keys, ts)]
    raw = {f"_raw_{c}": F.col(c) for c in sources}
    filled = fill.gap_fill_policy(placed.withColumns(raw), keys, ts, skip=tuple(raw))
    narrow = filled.select(
        *keys,
        ts,
        layout.POS,
        layout.LEN,
        *[F.col(f"_raw_{c}").alias(c) for c in sources],
        *[F.col(c).alias(f"_clean_{c}") for c in sources],
    )
    return cut_lineage(narrow, "sources")


def featured_with_index(df: DataFrame, keys=layout.KEYS, ts=layout.TIME, only=None) -> DataFrame:
    """Index, targets and features from a single block layout.

    The halo holds 72 rows back for the features and 72 ahead for the targets; the averages
    behind a target 72 rows ahead reach 23 rows back from there, which is inside.
    So one exchange and one sort serve the index averages, the leads and all features.
    """
    converted = air.convert_units(df)
    sources = converted.columns
    blocks = layout.in_blocks(converted, features.REACH, max(fixed.HORIZONS), keys, ts)
    averaged = blocks.df.withColumns(index.averages(sources, blocks.window))
    with_index = index.add_index(averaged)
    subs = [f"{p}_aqi" for p in fixed.DOMINANCE_ORDER]
    clean = guards.drop_leakage(with_index).drop(*subs)
    rowwise = clean.withColumns(features.row_features(clean, ts))
    targets = {f"target_aqi_{h}h": F.lead("numerical_aqi", h).over(blocks.window) for h in fixed.HORIZONS}
    specs = features.window_feature_specs(sources, only)
    return blocks.native(running.with_windows(rowwise.withColumns(targets), blocks.window, specs))


def training_table(df: DataFrame, keys=layout.KEYS, ts=layout.TIME, trim: bool = True, only=None) -> DataFrame:
    """Features of past and present, targets of the future, gaps filled, outliers clipped.

    Features are computed from the raw columns, as lags and means describe the raw series;
    the columns themselves end up filled and clipped. ``trim=False`` keeps the newest rows,
    whose targets are still unknown: the table to forecast from. ``only`` names the window
    features to build when not all of them are wanted.
    """
    sources = [c for c in df.columns if c not in (*keys, ts)]
    pollutants = [f"_clean_{c}" for c in fixed.POLLUTANTS if c in sources]
    base = clean_sources(df, keys, ts)
    # one small row per series each: stored, their size is known when the wide plan is made
    fences = cut_lineage(stats.quartiles(base, pollutants, keys), "fences")
    wide = featured_with_index(stats.iqr_clip(base, pollutants, keys, fences), keys, ts, only)
    settled = wide.withColumns({c: F.col(f"_clean_{c}") for c in sources}).drop(*[f"_clean_{c}" for c in sources])
    untouched = (*keys, ts, layout.POS, layout.LEN, "numerical_aqi", *fixed.TARGETS, *sources)
    out = stats.fixed_clip(fill.fill_constant(settled, skip=untouched), CLIP_LIMITS)
    if trim:
        # a row too near the end of its series lacks a target, so this also trims the tail
        out = out.na.drop(subset=list(fixed.TARGETS))
    out = out.drop("numerical_aqi", layout.POS, layout.LEN)
    guards.check_names(guards.feature_columns(out, keys, ts))
    return out


def final_table(
    df: DataFrame, selected: list[str], fit_on: DataFrame | None = None, keys=layout.KEYS, ts=layout.TIME
) -> DataFrame:
    """time, targets, placeholder pollutant, target time, and the scaled selected features."""
    guards.check_names(selected)
    cleaned = df.withColumns({c: F.coalesce(air.finite(F.col(c).cast("double")), F.lit(0.0)) for c in selected})
    fit = fit_on if fit_on is not None else cleaned
    scaled = stats.standardise(cleaned, selected, fit_on=fit)
    return scaled.select(
        *keys,
        ts,
        *fixed.TARGETS,
        F.lit("unknown").alias("primary_pollutant"),
        clock.hours_later(F.col(ts), 24).alias("target_timestamp"),
        *selected,
    )
