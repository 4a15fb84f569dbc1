"""Derived vessel and voyage attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.dates import stamp
from tidewatch.functions.seismic import first_true

C = F.col


def flag(condition: Column) -> Column:
    """Condition as TRUE/FALSE, unknown counts as FALSE."""
    return F.coalesce(condition, F.lit(False))


def status_has(word: str, status: Column | None = None) -> Column:
    return flag(F.lower(C("REPORTED_STATUS") if status is None else status).contains(word))


def temporal_anomaly(arrived: Column, departed: Column) -> Column:
    return flag(arrived < departed)


def missing_times(*dates: Column) -> Column:
    absent = F.lit(True)
    for d in dates:
        absent = absent & d.isNull()
    return absent


def vessel_age(year_built: Column, as_of: str) -> Column:
    return F.year(stamp(as_of)).cast("bigint") - year_built


def age_category(age: Column) -> Column:
    new, mid, aging = fixed.AGE_LIMITS.values()
    return first_true(
        (age.isNull(), "Unknown"), (age < new, "New"), (age <= mid, "Mid-life"), (age <= aging, "Aging"), default="Old"
    )


def size_category(deadweight: Column) -> Column:
    steps = [(deadweight < limit, name) for name, limit in fixed.SIZE_LIMITS.items()]
    return first_true((deadweight.isNull(), "Unknown"), *steps, default="Capesize")


def voyage_status(as_of: str) -> Column:
    """Reported status, else what the dates and ports tell.

    A label for waiting at anchor exists in the vocabulary but a reported
    anchorage is always returned as reported, so it is not derived here.
    """
    destination, origin = C("DESTINATION_PORT_NAME"), C("LAST_PORT_NAME")
    overdue = C("ESTIMATED_ARRIVAL_DATE") < F.to_date(stamp(as_of))
    return first_true(
        (C("REPORTED_STATUS").isNotNull(), C("REPORTED_STATUS")),
        (C("ACTUAL_ARRIVAL_DATE").isNotNull(), "Arrived / At Berth"),
        (destination.isNotNull() & C("DEPARTURE_DATE").isNotNull(), "In Transit"),
        (origin.isNotNull() & destination.isNull(), "At Port"),
        (overdue, "Delayed"),
        default="Unknown",
    )


def activity(report_date: Column, as_of: str) -> Column:
    since = stamp(as_of) - F.expr(f"INTERVAL {fixed.ACTIVE_HOURS} HOURS")
    return F.when(report_date >= since, "Active").otherwise("Inactive")


def required_facility(vessel_type: Column) -> Column:
    """Facility flag a vessel type needs; NULL when any port will do."""
    kind = F.lower(vessel_type)
    return first_true(*[(kind.contains(word), flag_name) for word, flag_name in fixed.FACILITY_KEYWORDS])
