"""Join of events and ports by great-circle distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.geo import Grid, Reach, haversine_km
from tidewatch.operators.joins import dimension_join

C = F.col

_EVENT_PLACE, _PORT_PLACE = ["_x", "_y", "_z"], ["_port_x", "_port_y", "_port_z"]


def proximity_join(
    events: DataFrame, ports: DataFrame, radius_km: float = fixed.PROXIMITY_KM, hint: str | None = "merge"
) -> DataFrame:
    """All (event, port) pairs within the radius, with ``DISTANCE_KM``.

    Events have ``LATITUDE, LONGITUDE``; ports ``PORT_LATITUDE,
    PORT_LONGITUDE``; other names must not clash. Each port is listed under
    every grid cell its cap touches and each event under its own cell, so the
    pairs come from an equi-join on the cell followed by the exact test.
    Points outside the valid coordinate range have no cell and no pair.

    A port is listed in dozens of cells, which Spark's sizes don't show before it would broadcast them from the driver.
    So by default both sides are sorted by cell and merged, and crowded cells are split at run time; a cell's pairs then lie
    together, which also stores them in fewer bytes. Without a ``hint`` Spark chooses, for ports that are known to be few.
    """
    grid, reach = Grid(radius_km), Reach(radius_km)
    event_valid = C("LATITUDE").between(-90, 90) & C("LONGITUDE").isNotNull()
    port_valid = C("PORT_LATITUDE").between(-90, 90) & C("PORT_LONGITUDE").between(-180, 180)
    placed = events.filter(event_valid).withColumns(
        {
            "_cell": grid.cells_of_point(C("LATITUDE"), C("LONGITUDE")),
            **dict(zip(_EVENT_PLACE, reach.place(C("LATITUDE"), C("LONGITUDE")), strict=True)),
        }
    )
    listed = ports.filter(port_valid).withColumns(
        {
            "_cell": F.explode(grid.cells_of_cap(C("PORT_LATITUDE"), C("PORT_LONGITUDE"))),
            **dict(zip(_PORT_PLACE, reach.place(C("PORT_LATITUDE"), C("PORT_LONGITUDE")), strict=True)),
        }
    )
    distance = haversine_km(C("LATITUDE"), C("LONGITUDE"), C("PORT_LATITUDE"), C("PORT_LONGITUDE"))
    near = reach.holds([C(c) for c in _EVENT_PLACE], [C(c) for c in _PORT_PLACE], distance)
    pairs = dimension_join(placed, listed, ["_cell"], "inner", residual=near, hint=hint)
    return pairs.drop("_cell", *_EVENT_PLACE, *_PORT_PLACE).withColumn("DISTANCE_KM", distance)
