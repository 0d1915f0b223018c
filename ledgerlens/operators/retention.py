"""Cohort, retention and new-vs-recurring client reports.

Scale notes
-----------
* First-purchase dates are a partial (map-side combined) ``min`` aggregate.
* The cohort table joins contracts to per-client first dates with a shuffle
  join on ``cliente_id``; the per-client side grows with the client count, so
  it is never force-broadcast.  A client holding a large share of the rows is
  a skewed partition that AQE's skew-join splits (the other side has one row
  per client).
* The monthly new/recurring report needs no join with the contract table at
  all: contracts are pre-aggregated to (client, month) — at most one row per
  client and month — and the per-client first date is a window over that
  small per-client set (bounded by the number of months, never by the number
  of contracts).  Distinct counts become sums of 0/1 flags, so there is no
  Expand of the input for three ``count(distinct ...)`` columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.dates import complete_months, month_label


def first_contract(contracts: DataFrame, client: str = "cliente_id",
                   date: str = "data_contrato", out: str = "primeira_data") -> DataFrame:
    """A1: first contract date per client (NULL clients dropped like an inner join)."""
    return (contracts.filter(F.col(client).isNotNull())
            .groupBy(client).agg(F.min(date).alias(out)))


def cohort_table(contracts: DataFrame, client: str = "cliente_id", date: str = "data_contrato",
                 amount: str = "valor_comissao") -> DataFrame:
    """A3: cohort (``safra``) x age in complete months: distinct clients and revenue."""
    base = contracts.select(client, date, amount)
    first = first_contract(base, client, date, "data_primeira_compra")
    joined = base.join(first, client, "inner")
    rows = joined.select(
        F.col(client),
        month_label(F.col("data_primeira_compra")).alias("safra"),
        complete_months(F.col("data_primeira_compra"), F.col(date)).alias("idade_meses"),
        F.col(amount),
    )
    agg = rows.groupBy("safra", "idade_meses").agg(
        F.count_distinct(client).alias("clientes"),
        F.sum(amount).cast("decimal(38,2)").alias("receita"),
    )
    return agg.select(
        "safra",
        F.concat(F.lit("M"), F.col("idade_meses").cast("string")).alias("mes"),
        F.col("idade_meses").cast("long").alias("idade_meses"),
        F.col("clientes").cast("long").alias("clientes"),
        "receita",
    )


def retention_curve(contracts: DataFrame, **kw) -> DataFrame:
    """A4: clients summed over cohorts for each age in months."""
    cohorts = cohort_table(contracts, **kw)
    return (cohorts.groupBy("mes", "idade_meses")
            .agg(F.sum("clientes").cast("long").alias("qtd_clientes"))
            .select("mes", "idade_meses", "qtd_clientes"))


def union_contracts(tables: dict[str, DataFrame], date_alias: dict[str, str] | None = None,
                    client: str = "cliente_id") -> DataFrame:
    """UNION ALL of DISTINCT (client, date) branches of live contracts.

    ``date_alias`` renames a branch's date column (e.g. ``data_cartao``)."""
    date_alias = date_alias or {}
    branches = []
    for name, df in tables.items():
        dcol = date_alias.get(name, "data_contrato")
        branches.append(df.filter(F.col("data_cancelamento").isNull())
                        .select(F.col(client), F.col(dcol).alias("data_contrato"))
                        .distinct())
    return reduce(lambda a, b: a.unionByName(b), branches)


def new_vs_recurring(contracts: DataFrame, client: str = "cliente_id",
                     date: str = "data_contrato") -> DataFrame:
    """A2: per month, distinct new clients (contract on the first-contract day)
    and recurring clients (a contract later than the first), with proportions.

    A same-day later contract counts a client as both (trap T10, kept)."""
    per_month = (contracts.filter(F.col(client).isNotNull())
                 .withColumn("mes_ano", month_label(F.col(date)))
                 .groupBy(client, "mes_ano")
                 .agg(F.max(date).alias("ultima"), F.min(date).alias("primeira_mes")))
    w = Window.partitionBy(client)
    flagged = per_month.withColumn("primeira", F.min("primeira_mes").over(w))
    flagged = flagged.select(
        "mes_ano",
        # the first contract's day lies in this month iff this month holds the minimum
        F.when(F.to_date("primeira_mes") == F.to_date("primeira"), 1).otherwise(0).alias("novo"),
        F.when(F.col("ultima") > F.col("primeira"), 1).otherwise(0).alias("recorrente"),
    )
    agg = flagged.groupBy("mes_ano").agg(
        F.sum("novo").cast("long").alias("contagem_novos"),
        F.sum("recorrente").cast("long").alias("contagem_recorrentes"),
        F.count(F.lit(1)).cast("long").alias("clientes"),
    )
    return agg.select(
        "mes_ano", "contagem_novos", "contagem_recorrentes",
        (F.col("contagem_novos").cast("double") / F.col("clientes").cast("double")).alias("proporcao_novos"),
        (F.col("contagem_recorrentes").cast("double") / F.col("clientes").cast("double")).alias("proporcao_recorrentes"),
    )
