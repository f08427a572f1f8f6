"""All registered queries of all areas."""

from __future__ import annotations

from weekloom.verification import demand, explore, features, forecasts, warehouse

AREAS = [warehouse.AREA, explore.AREA, demand.AREA, features.AREA, forecasts.AREA]


def all_queries():
    return {name: q for area in AREAS for name, q in area.queries.items()}


def all_oracles():
    return {name: s for area in AREAS for name, s in area.oracles.items()}
