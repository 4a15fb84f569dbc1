"""Domain tables built lazily from the benchmark tables, for use in queries."""

from __future__ import annotations

import functools

from tidewatch import adapters as A
from tidewatch.plans import gold, recommend, silver, star
from tidewatch.sources.writers import staged


def once(method):
    """Build the plan on first use and hand out the same lazy frame after."""

    @functools.wraps(method)
    def get(self):
        if method.__name__ not in self.built:
            self.built[method.__name__] = method(self)
        return self.built[method.__name__]

    return get


class Domain:
    """Named lazy tables over one data directory."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.dir, self.built = spark, sf_dir, {}

    # inputs
    @once
    def seismic(self):
        return A.seismic(self.spark, self.dir)

    @once
    def changes(self):
        return A.live(self.spark, self.dir)

    @once
    def live(self):
        from tidewatch.streaming.cdc import live_events

        return live_events(self.changes())

    @once
    def ports(self):
        return A.ports(self.spark, self.dir)

    @once
    def aliases(self):
        return A.aliases(self.spark, self.dir)

    @once
    def vessels(self):
        return A.vessels(self.spark, self.dir)

    # cleaned
    @once
    def silver_events(self):
        return silver.silver_seismic_events(self.seismic(), A.AS_OF)

    @once
    def silver_ports(self):
        return silver.silver_ports(self.ports(), A.AS_OF)

    @once
    def silver_vessels(self):
        return silver.silver_vessels(self.vessels())

    # enriched
    @once
    def gold_events(self):
        return gold.gold_seismic_events(self.silver_events())

    @once
    def gold_vessels(self):
        return gold.gold_vessels(self.silver_vessels(), A.VESSELS_AS_OF)

    @once
    def gold_ports(self):
        return gold.gold_ports(self.silver_ports())

    @once
    def facilities(self):
        return gold.gold_port_infrastructure_facilities(self.gold_ports())

    @once
    def supply(self):
        return gold.gold_port_supply_details(self.gold_ports())

    @once
    def details(self):
        return gold.gold_vessels_with_port_details(
            self.gold_vessels(), self.gold_ports(), self.aliases(), A.VESSELS_AS_OF
        )

    @once
    def proximity(self):
        return self.proximity_of(self.gold_events())

    def proximity_of(self, events):
        return gold.gold_seismic_port_proximity(events, self.silver_ports())

    @once
    def daily(self):
        return gold.daily_aggregated_seismic_events(self.gold_events())

    # star
    @once
    def dim_port(self):
        return star.dim_port_of(self.gold_ports(), A.AS_OF)

    @once
    def dim_event(self):
        return star.dim_seismic_event(self.gold_events(), A.AS_OF)

    @once
    def voyages(self):
        return star.fact_vessel_voyage(self.details(), self.dim_port(), self.aliases(), A.VESSELS_AS_OF)

    @once
    def prepared_ports(self):
        risk = staged(recommend.recent_port_risk(self.gold_events(), self.silver_ports(), A.AS_OF), "port-risk")
        return recommend.prepare_ports(recommend.scoring_ports_of(self.gold_ports()), risk)
