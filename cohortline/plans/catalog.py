"""All queries by name. Each takes a warehouse and returns a DataFrame."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from cohortline.plans import dashboards, exports, fragments, insights, quality, serving
from cohortline.warehouse import LAYERS, MODELS, Warehouse

Query = Callable[[Warehouse], DataFrame]


def _over_tables(build: Callable[..., DataFrame]) -> Query:
    """A plan function as a query: parameters without a default name its tables."""

    def query(w: Warehouse) -> DataFrame:
        parameters = inspect.signature(build).parameters.values()
        names = [p.name for p in parameters if p.default is inspect.Parameter.empty]
        return build(*(w.workspace if name == "workspace" else w.table(name) for name in names))

    return query


def _public(module, prefix: str = "") -> dict[str, Callable[..., DataFrame]]:
    return {
        name: member
        for name, member in inspect.getmembers(module, inspect.isfunction)
        if member.__module__ == module.__name__ and name.startswith(prefix) and not name.startswith("_")
    }


def _queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    found.update(_public(fragments))
    for name, model in MODELS.items():
        if model.layer in LAYERS:
            found[name] = partial(Warehouse.plan, name=name)
    helpers = {"run_query", "approvals_per_year", "trials_per_phase_year", "trust_lights"}
    for module, prefix in ((serving, ""), (dashboards, ""), (exports, "export_"), (insights, "")):
        for name, build in _public(module, prefix).items():
            if name not in helpers:
                found[name] = _over_tables(build)
    found["trust_lights"] = lambda w: dashboards.trust_lights(found["pipeline_trust_scorecard"](w))
    for name in ("not_null", "unique", "accepted_values", "relationships"):
        found[f"dq_{name}"] = lambda w, check=getattr(quality, name): check(w.rows_of)
    return found


QUERIES = _queries()
