"""Lead enrichment: contact resolution, latest state, enrichment pass and
lookup budget (J7, J10, C24, C30, P9, P21, F7, J29).

The reference sends phone lists as IN-lists in chunks and polls; here the
phone list is a DataFrame and every lookup is a join (semi-join for the IN
list), so the whole candidate set is resolved in one distributed pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.functions.similarity import with_distinct_ratio
from ledgerlens.operators.skew import latest_per_key

PLACEHOLDER_CPF = "99999999999"
LOOKUP_BUDGET = 5000


def latest_state(addresses: DataFrame) -> DataFrame:
    """State of each client's newest address (greatest address id)."""
    return latest_per_key(addresses, ["cliente_id"], ["id"], ["uf"])


def client_info(phones: DataFrame, clients: DataFrame, client_contacts: DataFrame, contacts: DataFrame,
                addresses: DataFrame) -> DataFrame:
    """Clients matching a phone list through their landline, mobile or
    an extra contact; with newest state (``ND`` when none), gender, birth
    date and registered name."""
    p = phones.select(S.digits_or_null(F.col("telefone")).alias("telefone")).filter(F.col("telefone").isNotNull()).distinct()
    by_land = clients.select(F.col("idTabela").alias("cliente_id"), F.col("telefone")).join(p, "telefone", "left_semi")
    by_mobile = clients.select(F.col("idTabela").alias("cliente_id"), F.col("celular").alias("telefone")).join(
        p, "telefone", "left_semi")
    extra = (client_contacts.join(contacts.select(F.col("id").alias("contato_id"),
                                                  S.digits_or_null(F.col("contato")).alias("telefone")), "contato_id")
             .select("cliente_id", "telefone").join(p, "telefone", "left_semi"))
    u = reduce(lambda a, b: a.unionByName(b), [by_land, by_mobile, extra]).distinct()
    cc = clients.select(F.col("idTabela").alias("cliente_id"), F.col("id").alias("cpf"), F.col("genero").alias("SEXO"),
                        F.col("data_nasc").alias("DATANASCIMENTO"), F.col("nome").alias("nome_cliente_cadastro"))
    j = u.join(cc, "cliente_id").join(latest_state(addresses), "cliente_id", "left")
    return j.select("cliente_id", "cpf", F.coalesce(F.col("uf"), F.lit("ND")).alias("UF"), "SEXO", "DATANASCIMENTO",
                    "nome_cliente_cadastro", "telefone")


def lookup_budget(candidates: DataFrame, budget: int = LOOKUP_BUDGET) -> DataFrame:
    """The distinct phones to look up this cycle, newest arrival first,
    at most ``budget`` (the budget is the feature: a top-k, not a sort)."""
    p = (candidates.select(S.digits_or_null(F.col("telefone")).alias("telefone"), "data_chegada")
         .filter(F.col("telefone").isNotNull())
         .groupBy("telefone").agg(F.max("data_chegada").alias("ultima_chegada")))
    return p.orderBy(F.col("ultima_chegada").desc(), F.col("telefone")).limit(budget)


def enrichment_pass(candidates: DataFrame, info: DataFrame) -> DataFrame:
    """Candidates (phone cleaned to 10-11 digits, P9) joined to the
    resolved client per phone (first by descending CPF), contact type for
    the unresolved (F7), name similarity (J29), and no-CPF rows forced to
    similarity 0 and no name (P21)."""
    c = (candidates.withColumn("telefone", S.digits(F.col("telefone")))
         .filter(F.length("telefone").between(10, 11)))
    best = latest_per_key(info, ["telefone"], ["cpf"], ["cliente_id", "cpf", "UF", "SEXO", "DATANASCIMENTO",
                                                         "nome_cliente_cadastro"])
    j = c.join(best, "telefone", "left")
    j = j.withColumn("tipo_contato", F.when(F.col("cliente_id").isNull(), S.phone_kind(F.col("telefone"))))
    j = j.withColumn("nome_up", F.upper("nome")).withColumn("cadastro_up", F.upper("nome_cliente_cadastro"))
    j = with_distinct_ratio(j, "nome_up", "cadastro_up", "semelhanca")
    no_cpf = F.col("cpf").isNull() | (F.trim(F.col("cpf")) == "") | (F.lower(F.col("cpf")) == "nan")
    return (j.withColumn("semelhanca", F.when(no_cpf, F.lit(0)).otherwise(F.col("semelhanca")))
            .withColumn("nome_cliente_cadastro", F.when(no_cpf, F.lit(None).cast("string"))
                        .otherwise(F.col("nome_cliente_cadastro")))
            .select(F.col("id").alias("negociacao_id"), "telefone", "cpf", "nome_cliente_cadastro", "SEXO", "UF",
                    "semelhanca", "DATANASCIMENTO", "tipo_contato"))
