"""Port flags, ratings, classes and the scores used for ranking."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.seismic import first_true, lookup
from tidewatch.functions.text import has_word

C = F.col


def bit(condition: Column) -> Column:
    """Condition as 1/0, unknown counts as 0."""
    return F.when(condition, 1).otherwise(0)


def supply_bits() -> dict[str, Column]:
    return {f: has_word(c, fixed.SUPPLY_WORDS) for f, c in fixed.SUPPLY_FLAGS.items()}


def communication_bits() -> dict[str, Column]:
    return {f: has_word(c, ["YES"]) for f, c in fixed.COMMUNICATION_FLAGS.items()}


def facility_bits() -> dict[str, Column]:
    return {f: has_word(c, ["YES"]) for f, c in fixed.FACILITY_FLAGS.items()}


def total(bits: dict[str, Column]) -> Column:
    return reduce(add, bits.values())


def rating(score: Column, excellent: int, good: int) -> Column:
    """Label of a score; anything above zero is at least limited."""
    top, second, third, none = fixed.RATING_LABELS
    return first_true((score >= excellent, top), (score >= good, second), (score >= 1, third), default=none)


def depth_class(pier: Column, channel: Column) -> Column:
    # greatest() skips NULL; both NULL stays NULL and falls to the default
    deepest = F.greatest(pier, channel)
    return first_true((deepest > 15, "Deep"), (deepest >= 8, "Medium"), (deepest > 0, "Shallow"), default="Unknown")


def primary_type() -> Column:
    """Kind of port from its facility flags; the first match decides."""
    has = {k: C(f"HAS_{k}_FACILITY") == 1 for k in ("OIL_TERMINAL", "LIQUID_BULK", "CONTAINER", "SOLID_BULK", "RO_RO")}
    oil, liquid, box, solid, roro = has.values()
    yard = C("DRY_DOCK_SIZE").isin("Medium", "Large") | (C("REPAIR_CAPABILITY") == "Major")
    return first_true(
        (oil & liquid, "Liquid Cargo & Oil Hub"),
        (oil, "Oil Terminal"),
        (liquid & ~box & ~solid, "Liquid Bulk Specialist"),
        (box & roro, "Container & Ro-Ro Port"),
        (box, "Container Port"),
        # no container facility from here on
        (roro & ~solid, "Ro-Ro Specialist (Vehicles)"),
        (solid & ~liquid, "Dry Bulk Port"),
        (roro, "Multi-Purpose Commercial Port"),
        (yard, "Shipyard & Maintenance Port"),
        default="General Cargo / Undefined",
    )


# --- ranking scores ----------------------------------------------------------


def yes_no(x: Column) -> Column:
    return bit(F.lower(F.trim(x)).isin("yes", "y", "true"))


def safety_score(shelter: Column, security: Column) -> Column:
    bonus = F.coalesce(lookup(F.lower(F.trim(shelter)), fixed.SHELTER_BONUS), F.lit(0.0))
    return F.least(F.lit(100.0), 50.0 + bonus + yes_no(security) * fixed.SECURITY_BONUS)


def depth_score(depth_class_: Column) -> Column:
    return F.coalesce(lookup(depth_class_, fixed.DEPTH_CLASS_SCORES), F.lit(fixed.NEUTRAL_SCORE))


def harbor_size_score(size: Column) -> Column:
    return F.coalesce(lookup(F.trim(size), fixed.HARBOR_SIZE_SCORES), F.lit(fixed.NEUTRAL_SCORE))


def infrastructure_score(depth: Column, harbor: Column) -> Column:
    return depth * 0.60 + harbor * 0.40


def distance_score(distance_km: Column) -> Column:
    return 100.0 * F.exp(-distance_km / fixed.DISTANCE_DECAY_KM)


def seismic_safety_score(risk: Column) -> Column:
    return F.greatest(F.lit(0.0), 100.0 - risk)


def final_score(supply: Column, infrastructure: Column, seismic: Column, communication: Column, weights=None) -> Column:
    w = weights or fixed.SCORE_WEIGHTS
    return (
        supply * w["supply"]
        + infrastructure * w["infrastructure"]
        + seismic * w["seismic"]
        + communication * w["communication"]
    )
