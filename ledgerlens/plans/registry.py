"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole driver tables.  Oracle SQL is an independent restatement that
DuckDB runs on the same parquet files (tables pre-registered as views).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}
_HEADLINE: list[str] = []


def query(name: str, oracle: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        if headline:
            _HEADLINE.append(name)
        return fn
    return deco


PLAN_MODULES = [
    "q_retention", "q_leads", "q_scalars", "q_reconcile", "q_rates", "q_funnel",
    "q_assign", "q_effectiveness", "q_sla", "q_merge", "q_ingest", "q_campaign", "q_queues", "q_enrichment", "q_contacts", "q_routing",
]


def _load_all() -> None:
    # Importing the plan modules registers their queries.
    import importlib
    for mod in PLAN_MODULES:
        full = f"ledgerlens.plans.{mod}"
        try:
            importlib.import_module(full)
        except ModuleNotFoundError as exc:
            if exc.name != full:
                raise


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def headline() -> list[str]:
    _load_all()
    return list(_HEADLINE)
