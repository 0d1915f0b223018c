"""Work queues served to the partner platform (P3-P5, O7, P24, F20-F24,
F38, F56, F57, J24).

Each queue is a filter plus an ordered top-n (``orderBy().limit(n)`` plans
as a top-k, no global sort), then presentation transforms.  Random ties of
the reference (``RAND()``) become a deterministic ``md5(seed || id)``
tie-break.  The HTTP endpoints and row locks are not built; the lock
expiry is part of the filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S
from ledgerlens.operators.assign import shuffle_key

SIMULATION_COLUMNS = ["id", "cpf", "nascimento", "marca", "ano", "modelo", "valor", "estado", "tipoVeiculo", "usadoNovo"]
QUOTE_COLUMNS = ["id", "cpf", "marca", "ano_combustivel", "modelo", "valor", "estado", "tipoVeiculo", "usadoNovo",
                 "uso_veiculo", "data_nascimento"]


def simulation_queue(classified: DataFrame, as_of, n: int = 1) -> DataFrame:
    """P3 + O7 + P24: next priority-1 simulation(s) whose lock expired."""
    t = D.ts_ntz(as_of)
    c = classified.filter(
        (F.col("prioridade") == 1)
        & ((F.col("consultando") == 0) | (F.col("locked_at") < t - F.expr("INTERVAL 5 MINUTES")))
        & F.col("enviado").isNull() & F.col("telefone").isNotNull() & F.col("cpf").isNotNull()
        & F.col("estado").isNotNull() & (F.col("estado") != "ND") & (F.col("semelhanca_nomes") >= 100)
        & F.col("data_nascimento").isNotNull() & (F.col("abriu_regua") == "NAO TESTADO")
        & ~F.col("canal").like("%seguro%") & ~F.lower(F.col("canal")).like("%quitados%")
        & F.col("ano").isNotNull() & F.col("veiculo").isNotNull() & F.col("marca").isNotNull()
        & F.col("valor").isNotNull() & (F.col("valor") > 0) & F.col("tipo_veiculo").isin("MOTO", "CARRO"))
    top = c.orderBy(F.col("data_chegada").desc(), shuffle_key()).limit(n)
    ano = F.trim(S.model_year_last(F.col("ano"))).try_cast("int")
    return top.select(
        "id", S.cpf_zfill(F.col("cpf")).alias("cpf"), D.format_br_date(F.col("data_nascimento")).alias("nascimento"),
        "marca", ano.alias("ano"), S.model_trim(F.col("veiculo")).alias("modelo"),
        S.amount_int(F.col("valor")).alias("valor"), S.state_name(F.col("estado")).alias("estado"),
        S.capitalize_first(F.col("tipo_veiculo")).alias("tipoVeiculo"),
        S.new_or_used(ano, F.year(t)).alias("usadoNovo"))


def plate_queue(queries: DataFrame, n: int = 1) -> DataFrame:
    """Next plate(s) without a plate lookup (lowest contact id first)."""
    q = queries.filter(F.col("data_placa").isNull()).orderBy("contato_id").limit(n)
    return q.select(S.cpf_zfill(F.col("cpf")).alias("cpf"), "placa")


def quote_queue(queries: DataFrame, as_of) -> DataFrame:
    """P5: plates looked up since yesterday, not yet quoted, with a model,
    plate not a ``CPF`` placeholder; newest first."""
    t = D.ts_ntz(as_of)
    q = queries.filter(F.col("data_consulta").isNull()
                       & (F.to_date("data_placa") >= F.date_sub(F.to_date(t), 1))
                       & F.col("modelo").isNotNull() & ~F.col("placa").startswith("CPF"))
    return q.orderBy(F.col("data_placa").desc()).select(
        F.col("contato_id").alias("id"), S.cpf_zfill(F.col("cpf")).alias("cpf"), "marca", "ano_combustivel", "modelo",
        S.amount_int(F.col("preco_medio_veiculo")).alias("valor"),
        S.state_name(F.col("uf_licenciamento")).alias("estado"),
        S.capitalize_first(F.col("tipo_veiculo")).alias("tipoVeiculo"),
        F.col("estado_veiculo").alias("usadoNovo"), S.usage_label(F.col("uso_veiculo")).alias("uso_veiculo"),
        D.format_br_date(F.col("data_nascimento")).alias("data_nascimento"))
