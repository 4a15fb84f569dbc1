"""Golden cases of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import dates, geo, keys, ports, seismic, text, vessels
from tidewatch.operators import aggregates
from tidewatch.plans import gold, silver, star

C = F.col


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, column, **given):
    """Value of a column over one row of text, double or int cells."""
    kinds = {str: "string", float: "double", int: "int", type(None): "string", dt.date: "date"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in given.items())
    return spark.createDataFrame([tuple(given.values())], schema).select(column).first()[0]


def test_numbers(spark):
    raw = [("82318",), ("-",), ("12.5",), (None,), ("-2.5",), ("99999999999999999999",)]
    assert [v[0] for v in values(spark, raw, "x string", text.try_number("x"))] == [82318, None, 13, None, -3, None]
    raw = [("49.2925N",), ("229",), ("None",), ("12d",), (" 1.5 ",), (".5",), ("1e3",)]
    assert [v[0] for v in values(spark, raw, "x string", text.try_coordinate("x"))] == [
        None, 229.0, None, None, 1.5, 0.5, 1000.0]


def test_report_stamp(spark):
    raw = [("2026-05-19 22:44",), ("x",)]
    assert [v[0] for v in values(spark, raw, "x string", text.try_timestamp("x").cast("string"))] == [
        "2026-05-19 22:44:00", None]


def test_categories(spark):
    raw = [(" Unknown ",), ("-",), ("N/A",), ("",), ("unknown",), ("Yes",), (None,)]
    assert [v[0] for v in values(spark, raw, "x string", text.clean_categorical("x"))] == [
        None, None, None, None, "unknown", "Yes", None]
    raw = [("None",), (" - ",), ("",), ("N/A",), (" Moored ",)]
    assert [v[0] for v in values(spark, raw, "x string", text.clean_status("x"))] == [None] * 4 + ["Moored"]
    assert values(spark, [(0.0,), (2.5,), (None,)], "x double", text.zero_to_null("x")) == [(None,), (2.5,), (None,)]


@pytest.mark.parametrize("spelling, parsed", [
    ("2024-01-02T03:04:05.678Z", "2024-01-02 03:04:05"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
    ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"), ("2024-01-02", "2024-01-02 00:00:00"),
    ("2024/01/02", "2024-01-02 00:00:00"), ("02/01/2024", "2024-01-02 00:00:00"),
    ("1704164645", "2024-01-02 03:04:05"), ("soon", None), ("may be", None), ("Monday", None),
    ("Tue, 02 Jan 2024 03:04:05 GMT", "2024-01-02 03:04:05"), ("Tue, 2 Jan 2024 03:04:05 +0200", "2024-01-02 01:04:05"),
    ("2 January 2024 03:04:05", "2024-01-02 03:04:05"), ("Jan 2, 2024", "2024-01-02 00:00:00"),
    ("Sept. 2, 2024", "2024-09-02 00:00:00"), ("September 2, 2024 3:04 pm", "2024-09-02 15:04:00"),
    ("january 2, 2024 12:04:05 AM", "2024-01-02 00:04:05"), ("2 jan 2024 11:04:05PM", "2024-01-02 23:04:05"),
    ("2024-01-02 03:04:05 PM", "2024-01-02 15:04:05"), ("2024-01-02 3:04 am", "2024-01-02 03:04:00"),
])
def test_best_effort(spark, spelling, parsed):
    assert one(spark, F.date_format(text.parse_best_effort("x"), "yyyy-MM-dd HH:mm:ss"), x=spelling) == parsed


def voyage(spark, departure, arrival, report):
    row = {c: None for c in ("name", "type", "year_built", "gross_tonnage", "deadweight", "length(m)", "beam(m)",
                             "detail_link", "last_port_country", "last_port_name", "destination_port_country",
                             "destination_port_name", "destination_port_lat", "destination_port_lon",
                             "reported_status")}
    row.update(name="V", departure_date=departure, arrival_date=arrival, report_date=report, _INGESTED_AT=report)
    schema = ", ".join(f"`{k}` string" for k in row)
    frame = spark.createDataFrame([tuple(row.values())], schema).withColumn(
        "_INGESTED_AT", F.to_timestamp("_INGESTED_AT"))
    out = silver.vessel_rows(frame).first()
    return out["DEPARTURE_DATE"], out["ACTUAL_ARRIVAL_DATE"], out["ESTIMATED_ARRIVAL_DATE"]


@pytest.mark.parametrize("departure, arrival, report, expected", [
    ("ATD: May 14, 19:11 UTC(5 days ago)", "ETA: Jun 1, 01:00(in 12 days)", "2026-05-19 22:44",
     (dt.date(2026, 5, 14), None, dt.date(2026, 6, 1))),
    ("ATA: Apr 23, 08:27 UTC(27 days ago)", "ETA: Apr 22, 22:00", "2026-05-19 22:44",
     (None, None, dt.date(2027, 4, 22))),
    ("ATD: May 18, 1:00 UTC", "ATA: May 19, 04:28 UTCARRIVED", "2026-05-19 22:44",
     (dt.date(2026, 5, 18), dt.date(2026, 5, 19), None)),
    ("", "ETA: -", "2026-05-19 22:44", (None, None, None)),
    ("ATD: Feb 29, 1:00", None, "2025-03-01 10:00", (dt.date(2024, 2, 29), None, None)),
    ("ATD: Feb 29, 1:00", None, "2027-03-01 10:00", (None, None, None)),
    ("ATD: Dec 30, 1:00", None, "2027-01-02 10:00", (dt.date(2027, 12, 30), None, None)),
    (None, "ETA: Jan 3, 1:00", "2026-12-28 10:00", (None, None, dt.date(2027, 1, 3))),
    (None, "ETA: May 18, 1:00", "2026-05-19 10:00", (None, None, dt.date(2026, 5, 18))),
])
def test_voyage_dates(spark, departure, arrival, report, expected):
    assert voyage(spark, departure, arrival, report) == expected


def test_strict_past_moves_future_days_back(spark):
    frame = spark.createDataFrame([("Dec 30", 2027, "2027-01-02")], "md string, y int, r string")
    strict = dates.resolve_past_date(C("md"), C("y"), F.to_timestamp("r"))
    assert frame.select(strict).first()[0] == dt.date(2026, 12, 30)


def test_day_difference_counts_boundaries(spark):
    got = one(spark, dates.days_between(F.to_date("a"), F.to_timestamp("b")), a="2026-05-14", b="2026-05-19 22:44:00")
    assert got == 5
    assert one(spark, dates.date_sk(F.to_date("a")), a="2026-05-09") == 20260509


def test_surrogate_key_marks_null(spark):
    a = one(spark, keys.surrogate_key(C("a"), C("b")), a="x", b=None)
    b = one(spark, keys.surrogate_key(C("a"), C("b")), a="x", b="")
    assert a != b and len(a) == 32
    assert one(spark, keys.pair_id("a", "b"), a="ev1", b=1234.0) == "ev1-1234"


def test_page_text(spark):
    for size, expected in [("229 / 32 m", ("229", "32")), ("229", (None, None)), ("1/2/3", (None, None))]:
        assert values(spark, [(size,)], "x string", *text.parse_size("x")) == [expected]
    for place, expected in [("Suez, Egypt", ("Suez", "Egypt")), ("Suez", ("Suez", None))]:
        assert values(spark, [(place,)], "x string", *text.split_name_country("x")) == [expected]
    sentence = "\nPort of X is located at 49.29N, 123.10W.\nAnother, line."
    assert values(spark, [(sentence,)], "x string", *text.parse_coord_sentence("x")) == [("49.29N", "123.10W")]
    assert values(spark, [("none here",)], "x string", *text.parse_coord_sentence("x")) == [(None, None)]
    assert one(spark, text.nav_status("x"), x="a\nNavigation Status\n Moored \nb") == "Moored"
    assert one(spark, text.nav_status("x"), x="a\nb") is None


def test_vessel_classes(spark):
    assert one(spark, vessels.age_category(vessels.vessel_age(C("y"), "2026-05-19")), y=2020) == "Mid-life"
    ages = [(0, "New"), (4, "New"), (5, "Mid-life"), (15, "Mid-life"), (16, "Aging"), (25, "Aging"), (26, "Old")]
    got = values(spark, [(a,) for a, _ in ages] + [(None,)], "a int", vessels.age_category(C("a")))
    assert [g[0] for g in got] == [b for _, b in ages] + ["Unknown"]
    sizes = [(39999, "Handysize"), (40000, "Handymax"), (60000, "Panamax"), (79999, "Panamax"), (82318, "Capesize")]
    got = values(spark, [(a,) for a, _ in sizes] + [(None,)], "a int", vessels.size_category(C("a")))
    assert [g[0] for g in got] == [b for _, b in sizes] + ["Unknown"]


@pytest.mark.parametrize("kind, facility", [
    ("Chemical/Oil Products Tanker", "HAS_OIL_TERMINAL_FACILITY"), ("Ro-Ro Cargo Ship", "HAS_RO_RO_FACILITY"),
    ("Liquid Bulk Carrier", "HAS_SOLID_BULK_FACILITY"), ("General Cargo Ship", None), (None, None),
    ("Vehicles Carrier", "HAS_RO_RO_FACILITY"), ("CONTAINER SHIP", "HAS_CONTAINER_FACILITY"),
])
def test_required_facility(spark, kind, facility):
    assert one(spark, vessels.required_facility(C("t")), t=kind) == facility


def test_voyage_status(spark):
    schema = ("REPORTED_STATUS string, ACTUAL_ARRIVAL_DATE date, DESTINATION_PORT_NAME string, DEPARTURE_DATE date,"
              " LAST_PORT_NAME string, ESTIMATED_ARRIVAL_DATE date")
    day = dt.date(2026, 5, 1)
    rows = [
        ("At anchor", day, "X", day, "Y", None), (None, day, "X", day, "Y", None), (None, None, "X", day, "Y", None),
        (None, None, None, day, "Y", None), (None, None, "X", None, "Y", day), (None, None, None, None, None, None),
    ]
    got = [v[0] for v in values(spark, rows, schema, vessels.voyage_status("2026-05-19"))]
    assert got == ["At anchor", "Arrived / At Berth", "In Transit", "At Port", "Delayed", "Unknown"]


def test_ratings_and_depth(spark):
    got = values(spark, [(5,), (3,), (1,), (0,)], "s int", ports.rating(C("s"), 5, 3))
    assert [g[0] for g in got] == ["Excellent", "Good", "Limited", "Unavailable"]
    got = values(spark, [(4,), (3,), (1,), (0,)], "s int", ports.rating(C("s"), 4, 3))
    assert [g[0] for g in got] == ["Excellent", "Good", "Limited", "Unavailable"]
    rows = [(16.0, None), (15.0, 8.0), (None, 7.9), (None, None)]
    got = values(spark, rows, "p double, c double", ports.depth_class(C("p"), C("c")))
    assert [g[0] for g in got] == ["Deep", "Medium", "Shallow", "Unknown"]


def test_primary_type_covers_every_combination(spark):
    """The ordered rules, written out independently, over all 32 flag sets and both yard states."""
    names = ["CONTAINER", "RO_RO", "LIQUID_BULK", "SOLID_BULK", "OIL_TERMINAL"]
    schema = ", ".join(f"HAS_{n}_FACILITY int" for n in names) + ", DRY_DOCK_SIZE string, REPAIR_CAPABILITY string"
    rows = [tuple((i >> k) & 1 for k in range(5)) + (dock, "None") for i in range(32) for dock in ("None", "Large")]

    def rule(box, roro, liquid, solid, oil, dock, _):
        if oil:
            return "Liquid Cargo & Oil Hub" if liquid else "Oil Terminal"
        if liquid and not (box or solid):
            return "Liquid Bulk Specialist"
        if box:
            return "Container & Ro-Ro Port" if roro else "Container Port"
        if roro:
            return "Multi-Purpose Commercial Port" if solid and liquid else (
                "Dry Bulk Port" if solid else "Ro-Ro Specialist (Vehicles)")
        if solid and not liquid:
            return "Dry Bulk Port"
        return "Shipyard & Maintenance Port" if dock == "Large" else "General Cargo / Undefined"

    got = [v[0] for v in values(spark, rows, schema, ports.primary_type())]
    assert got == [rule(*r) for r in rows]


def test_ranking_scores(spark):
    rows = [("Excellent", "Yes"), (None, None), ("fair", "no")]
    assert values(spark, rows, "a string, b string", ports.safety_score(C("a"), C("b"))) == [(100.0,), (50.0,), (60.0,)]
    rows = [(0.0, 100.0), (250.0, 88.25), (1000.0, 60.65)]
    got = values(spark, rows, "d double, e double", F.round(ports.distance_score(C("d")), 2))
    assert [g[0] for g in got] == [r[1] for r in rows]
    infra = ports.infrastructure_score(ports.depth_score(F.lit("Deep")), ports.harbor_size_score(F.lit("Large")))
    final = ports.final_score(F.lit(5), infra, F.lit(100.0), F.lit(4))
    assert round(spark.range(1).select(final).first()[0], 2) == 57.1
    assert values(spark, [(" Y ",), ("TRUE",), ("no",), (None,)], "x string", ports.yes_no(C("x"))) == [(1,), (1,), (0,), (0,)]


def test_seismic_classes(spark):
    got = values(spark, [(7.0,), (5.0,), (4.9,), (None,)], "m double", seismic.magnitude_class(C("m")))
    assert [g[0] for g in got] == ["Major", "Moderate", "Minor", "Minor"]
    rows = [(6.0, 10.0, 100.0, 78.0), (10.0, 10.0, 0.0, 100.0), (5.0, None, 250.0, 40.0), (None, 10.0, 0.0, None),
            (0.0, 70.0, 500.0, 15.0), (0.0, 300.0, 500.0, 15.0), (0.0, 300.1, 500.0, 5.0)]
    schema = "m double, d double, k double, e double"
    assert values(spark, rows, schema, seismic.risk_score(C("m"), C("d"), C("k"))) == [(r[3],) for r in rows]
    got = values(spark, [(75.0,), (50.0,), (25.0,), (24.9,), (None,)], "r double", seismic.risk_band(C("r")))
    assert [g[0] for g in got] == ["CRITICAL", "HIGH", "MODERATE", "LOW", "LOW"]


def test_distance(spark):
    quarter = 6371.0 * 3.141592653589793 / 2
    cases = [(0.0, 0.0, 0.0, 90.0, quarter), (90.0, 0.0, 0.0, 17.0, quarter), (10.0, 180.0, 10.0, -180.0, 0.0),
             (0.0, 0.0, 0.0, 180.0, 2 * quarter)]
    schema = "a double, b double, c double, d double, e double"
    got = values(spark, cases, schema, geo.haversine_km(C("a"), C("b"), C("c"), C("d")))
    for g, c in zip(got, cases, strict=True):
        assert g[0] == pytest.approx(c[4], abs=1e-6)


def events_of(spark, rows):
    schema = "EVENT_ID string, REGION string, MAGNITUDE double, EARTHQUAKE_TIME string"
    return spark.createDataFrame(rows, schema).withColumn("EARTHQUAKE_TIME", F.to_timestamp("EARTHQUAKE_TIME"))


def test_six_small_events_are_critical(spark):
    rows = [(f"e{i}", "R", 2.0, "2026-05-01 01:00:00") for i in range(6)]
    assert gold.daily_aggregated_seismic_events(events_of(spark, rows)).first()["DAILY_RISK_LEVEL"] == "CRITICAL"


def test_rolling_mean_ignores_gaps(spark):
    rows = [(f"{d}-{i}", "R", 2.0, f"2026-05-{d:02d} 00:00:00") for d, n in ((1, 2), (2, 4), (10, 6)) for i in range(n)]
    stats = aggregates.daily_region_stats(events_of(spark, rows))
    rolled = aggregates.rolling_rows_avg(stats).orderBy("EVENT_DATE").collect()
    assert [r["ROLLING_7D_AVG_EVENTS"] for r in rolled] == [2.0, 3.0, 4.0]
    calendar = aggregates.rolling_rows_avg(stats, calendar=True).orderBy("EVENT_DATE").collect()
    assert [r["ROLLING_7D_AVG_EVENTS"] for r in calendar] == [2.0, 3.0, 6.0]


def test_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 730
    last = days.orderBy(F.col("DATE_SK").desc()).first()
    assert (last["DATE_SK"], last["DAY_NAME"], last["MONTH_NAME"], last["WEEK_OF_YEAR"]) == (20261231, "Thu", "Dec", 53)


def test_tenths_equal_round(spark):
    from tidewatch.functions.seismic import tenths

    ties = [(n + 0.5) / 10 * s for n in range(0, 1200, 7) for s in (1, -1, 1 + 2e-16, 1 - 2e-16)]
    odd = [None, float("nan"), float("inf"), -float("inf"), -0.0, -0.01, 1e300, -1e300, 1e9, 123456789.05, 5e15 + 0.5]
    df = spark.createDataFrame([(x,) for x in ties + odd + [n / 37 for n in range(-400, 3700)]], "x double")
    assert df.filter(~tenths(F.col("x")).eqNullSafe(F.round("x", 1))).count() == 0
