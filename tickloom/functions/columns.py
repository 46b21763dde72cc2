"""Column expressions: labels, bands and validity rules.  All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tickloom.schemas import FEATURES

# Fixed values of the label, the rule baseline and the published bands.
SPIKE_THRESHOLD = 0.041799
RULE_VOLATILITY, RULE_RETURN, RULE_INTENSITY = 0.03, 0.01, 50.0
MODEL_VERSIONS = {"ml": "1.0", "baseline": "baseline-1.0"}


def per(a: Column, b: Column | float) -> Column:
    """a / b as a double, NULL where b is 0 (a plain division by 0 ends the job in ANSI mode)."""
    return F.try_divide(a.cast("double"), b if isinstance(b, Column) else F.lit(b))


def above(value: Column, limit: Column | float) -> Column:
    """value > limit, and false for NaN (which Spark orders above every number)."""
    return (value > limit) & ~F.isnan(value.cast("double"))


def band(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit is strictly above ``value``."""
    out = None
    for limit, label in limits:
        out = F.when(value < limit, label) if out is None else out.when(value < limit, label)
    return out.otherwise(otherwise)


def band_above(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit ``value`` strictly exceeds; limits in falling order."""
    out = None
    for limit, label in limits:
        out = F.when(above(value, limit), label) if out is None else out.when(above(value, limit), label)
    return out.otherwise(otherwise)


def spread_percent(price: Column, bid: Column, ask: Column) -> Column:
    quoted = above(price, 0) & (ask >= bid) & ~F.isnan(ask)
    return F.when(quoted, (ask - bid) / price * 100).otherwise(F.lit(0.0))


def percent_change(now: Column, before: Column) -> Column:
    return per(now - before, before) * 100


def spike_label(volatility: Column, threshold: float = SPIKE_THRESHOLD) -> Column:
    """Present-window label: strictly above the threshold."""
    return above(volatility, threshold).cast("int")


def liquidity_status(spread: Column) -> Column:
    return band(spread, [(0.01, "High"), (0.05, "Medium")], "Low")


def activity_status(intensity_30s: Column) -> Column:
    return band(intensity_30s, [(1, "Quiet"), (5, "Normal")], "Active")


def class_label(prediction: Column) -> Column:
    return F.when(prediction == 1, "spike").otherwise("normal")


def pr_auc_rating(pr_auc: Column) -> Column:
    return band_above(
        pr_auc, [(0.95, "Outstanding"), (0.80, "Excellent"), (0.60, "Good"), (0.30, "Moderate")], "Poor"
    )


def latency_assessment(p95_ms: Column) -> Column:
    return band(p95_ms, [(50, "EXCELLENT"), (100, "GOOD"), (200, "ACCEPTABLE")], "NEEDS IMPROVEMENT")


def drift_score_band(score: Column) -> Column:
    return band(score, [(0.3, "none"), (0.5, "minor"), (0.7, "moderate")], "high")


def drift_share_action(share: Column) -> Column:
    """Retraining response to the share (0..1) of drifted features."""
    return F.when(share < 0.3, "schedule").when(share <= 0.5, "accelerate").otherwise("rollback")


def lag_band(lag: Column) -> Column:
    return band(lag, [(1000, "green"), (5000, "yellow"), (10000, "orange")], "red")


def missing(c: str) -> Column:
    """NULL or NaN, which a data frame library counts as missing alike."""
    return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))


def rejected_features(columns: Sequence[str] = FEATURES) -> Column:
    """Names of required features that are absent or not numeric, as an array."""
    return F.filter(
        F.array(*(F.when(F.col(c).try_cast("double").isNull(), F.lit(c)) for c in columns)),
        lambda x: x.isNotNull(),
    )
