"""Labels and risk of seismic events."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def lookup(code: Column, table: dict) -> Column:
    """Value of the code in a small fixed table, NULL when absent."""
    return F.try_element_at(F.create_map(*[F.lit(v) for v in chain(*table.items())]), code)


def label_event_type(code: Column) -> Column:
    return F.coalesce(lookup(code, fixed.EVENT_TYPE_LABELS), code)


def label_magnitude_type(code: Column) -> Column:
    return F.coalesce(lookup(code, fixed.MAGNITUDE_TYPE_LABELS), code)


def first_true(*cases: tuple[Column, object], default=None) -> Column:
    """Ordered branches: value of the first condition that holds."""
    chain_ = F
    for condition, value in cases:
        chain_ = chain_.when(condition, value)
    return chain_.otherwise(default)


def magnitude_class(mag: Column) -> Column:
    return first_true((mag >= 7, "Major"), (mag >= 5, "Moderate"), default="Minor")


def intensity_bucket(mag: Column) -> Column:
    cases = [(mag < limit, name) for name, limit in fixed.INTENSITY_BUCKETS.items()]
    return first_true(*cases, default=fixed.INTENSITY_TOP_BUCKET)


def tenths(x: Column) -> Column:
    """``round(x, 1)``, which goes by way of decimal text; that is needed only near a tie and for large values."""
    shifted = x * 10
    plain = (F.abs(x) < 1e9) & (F.abs(shifted - F.floor(shifted) - 0.5) > 1e-6)
    return F.when(plain, F.floor(shifted + 0.5) / 10).otherwise(F.round(x, 1))


def risk_score(mag: Column, depth_km: Column, distance_km: Column) -> Column:
    """0-100 risk of an event to a port, one decimal; NULL magnitude gives NULL.

    Up to 40 points for magnitude, 30 / 15 / 5 for shallow / medium / deep (or
    unknown) focus, and up to 30 for closeness.
    """
    focus = first_true((depth_km < 70, 30.0), (depth_km <= 300, 15.0), default=5.0)
    closeness = F.greatest(F.lit(0.0), (fixed.PROXIMITY_KM - distance_km) / fixed.PROXIMITY_KM) * 30
    total = mag / 10.0 * 40 + focus + closeness
    return F.when(mag.isNotNull() & distance_km.isNotNull(), tenths(F.least(F.lit(100.0), total)))


def daily_risk_level(max_mag: Column, intensity: Column, events: Column, rolling: Column) -> Column:
    return first_true(
        ((max_mag >= 7) | (intensity > 5), "CRITICAL"),
        ((max_mag >= 5.5) | (events > rolling * 1.5), "HIGH"),
        (max_mag >= 4, "MODERATE"),
        default="LOW",
    )


def daily_risk_score(level: Column) -> Column:
    return F.coalesce(lookup(level, {"CRITICAL": 4, "HIGH": 3, "MODERATE": 2}), F.lit(1))


def risk_band(score: Column) -> Column:
    return first_true((score >= 75, "CRITICAL"), (score >= 50, "HIGH"), (score >= 25, "MODERATE"), default="LOW")
