"""Dynamic predicates and routing.

``build_predicate`` replaces the reference's SQL-text query builder with a
Column: literal conditions, equality conditions skipped when the value is
None, IN lists skipped when empty, all AND-ed; no condition -> no filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import ts_ntz


def build_predicate(literals: list[Column] | None = None, equals: dict | None = None,
                    in_lists: dict | None = None, not_in_lists: dict | None = None) -> Column:
    """AND of the given conditions (``lit(True)`` when there are none)."""
    conds = list(literals or [])
    conds += [F.col(c) == F.lit(v) for c, v in (equals or {}).items() if v is not None]
    conds += [F.col(c).isin(*vs) for c, vs in (in_lists or {}).items() if vs]
    conds += [~F.col(c).isin(*vs) for c, vs in (not_in_lists or {}).items() if vs]
    return reduce(lambda a, b: a & b, conds, F.lit(True))


# Platform by lead priority, and the sent type per platform.
PLATFORM_BY_PRIORITY = {1: "CRM_WHATSAPP", 2: "CRM_WHATSAPP2", 3: "Consultores"}
SEND_TYPE = {"CRM_WHATSAPP": "CRM", "CRM_WHATSAPP2": "CRM", "Consultores": "CONSULTOR", "SMS": "SMS"}


def route_by_platform(classified: DataFrame) -> DataFrame:
    """A literal platform column for unsent leads by priority (rows
    without a platform are not dispatched); each platform is then a
    ``filter`` feeding its sink."""
    plat = None
    for p, name in PLATFORM_BY_PRIORITY.items():
        cond = F.col("prioridade") == p
        plat = F.when(cond, F.lit(name)) if plat is None else plat.when(cond, F.lit(name))
    kind = None
    for name, k in SEND_TYPE.items():
        cond = F.col("plataforma") == name
        kind = F.when(cond, F.lit(k)) if kind is None else kind.when(cond, F.lit(k))
    out = classified.filter(F.col("enviado").isNull()).withColumn("plataforma", plat)
    return out.filter(F.col("plataforma").isNotNull()).withColumn("tipo_envio_novo", kind)


def sent_marking(routed: DataFrame, as_of) -> DataFrame:
    """K5: the update each dispatched lead gets: sent flag, type and time."""
    return routed.select("id", F.lit(1).alias("enviado"), F.col("tipo_envio_novo").alias("tipo_envio"),
                         ts_ntz(as_of).alias("data_hora_enviado"))
