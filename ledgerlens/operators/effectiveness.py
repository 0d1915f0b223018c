"""Campaign effectiveness and prior-contract features.

Every per-client measure is a partial aggregate keyed by the client; the
client list is enriched with one left join per measure (J11/J28) and the
summary is a single global aggregate unpivoted with ``stack`` (A21).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S

SUMMED = ["tabulacoes", "Total_Liberado", "tabulacoes_efetivas", "Contratos", "valor_comissao", "base_comissao"]
EXCLUDED_PRODUCT = "SEGURO PRESTAMISTA"


def merge_many(base: DataFrame, frames: list[DataFrame], on: str, how: str = "left") -> DataFrame:
    """N-way merge on one key."""
    return reduce(lambda a, b: a.join(b, on, how), frames, base)


def key_frequency(df: DataFrame, key: str, name: str) -> DataFrame:
    """Frequency of a key, NULL excluded."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("long").alias(name))


def client_effectiveness(clients: DataFrame, tabs: DataFrame, production: DataFrame, start: str, end: str) -> DataFrame:
    """J28 + A19 + A20: per client, tabulations (total, effective), production
    sums in ``[start, end)`` and contract count without credit insurance,
    zero-filled."""
    cl = clients.select(S.cpf_mask(F.col("cliente_id")).alias("cliente_id"))
    t = tabs.withColumn("cliente_id", S.cpf_mask(F.col("cpf")))
    tab_total = key_frequency(t, "cliente_id", "tabulacoes")
    tab_eff = key_frequency(t.filter(F.col("efetiva")), "cliente_id", "tabulacoes_efetivas")
    p = (production.withColumn("cliente_id", S.cpf_mask(F.col("cliente_id")))
         .filter((F.col("data_contrato") >= F.lit(start).cast("timestamp_ntz"))
                 & (F.to_date("data_contrato") <= F.date_sub(F.lit(end).cast("date"), 1))))
    sums = p.groupBy("cliente_id").agg(F.sum("Total_Liberado").alias("Total_Liberado"),
                                       F.sum("valor_comissao").alias("valor_comissao"),
                                       F.sum("base_comissao").alias("base_comissao"))
    n_contracts = key_frequency(p.filter(~F.coalesce(F.col("produto") == EXCLUDED_PRODUCT, F.lit(False))),
                                "cliente_id", "Contratos")
    out = merge_many(cl, [tab_total, sums, tab_eff, n_contracts], "cliente_id")
    return out.fillna(0, SUMMED)


def effectiveness_summary(per_client: DataFrame) -> DataFrame:
    """Column totals as (Campo, Soma), proportion of tabulated clients,
    tabulated-client counts and profitability (commission / base)."""
    agg = per_client.agg(
        *[F.sum(F.col(c).cast("decimal(38,2)")).cast("decimal(38,2)").alias(c) for c in SUMMED],
        F.count(F.lit(1)).cast("long").alias("_n"),
        F.sum(F.when(F.col("tabulacoes") > 0, 1).otherwise(0)).cast("long").alias("_tab"),
        F.sum(F.when(F.col("tabulacoes_efetivas") > 0, 1).otherwise(0)).cast("long").alias("_tab_eff"))
    pairs = ", ".join(f"'{c}', `{c}`" for c in SUMMED)
    long = agg.selectExpr(f"stack({len(SUMMED)}, {pairs}) AS (Campo, Soma)", "_n", "_tab", "_tab_eff",
                          "valor_comissao AS _vc", "base_comissao AS _bc")
    return long.select(
        "Campo", "Soma",
        F.when(F.col("Campo") == "tabulacoes",
               F.when(F.col("_n") > 0, F.col("_tab").cast("double") / F.col("_n").cast("double") * F.lit(100.0))
               .otherwise(F.lit(0.0))).alias("Proporcao"),
        F.when(F.col("Campo") == "tabulacoes", F.col("_tab"))
         .when(F.col("Campo") == "tabulacoes_efetivas", F.col("_tab_eff")).alias("Clientes_Tabulados"),
        F.when(F.col("Campo") == "valor_comissao",
               F.when(F.col("_bc") != 0, F.col("_vc").cast("double") / F.col("_bc").cast("double") * F.lit(100.0))
               .otherwise(F.lit(0.0))).alias("Rentabilidade"))


def prior_contracts(production: DataFrame, start: str) -> DataFrame:
    """Per client, contracts in the year before ``start`` (366 days back
    to the day before) and all earlier ones since 1990, in one pass."""
    d = F.to_date("data_contrato")
    s = F.lit(start).cast("date")
    last_year = (d >= F.date_sub(s, 366)) & (d <= F.date_sub(s, 1))
    before = (d >= F.lit("1990-01-01").cast("date")) & (d <= F.date_sub(s, 367))
    p = production.withColumn("cpf", S.cpf_mask(F.col("cliente_id"))).filter(last_year | before)
    return p.groupBy("cpf").agg(F.sum(F.when(last_year, 1).otherwise(0)).cast("long").alias("qtd_contratos_ultimo_ano"),
                                F.sum(F.when(before, 1).otherwise(0)).cast("long").alias("qtd_contratos_anteriores"))
