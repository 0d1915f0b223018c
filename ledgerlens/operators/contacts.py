"""Client/phone and contact-history loads (C25, C26, K4, F4, F8, F27, P9,
J27, S10, S11).

The reference pages through sources 100,000 rows at a time and month by
month; here each load is one partitioned read and one set of joins —
paging and month slicing are what Spark's partitions already do (the
month remains available as a partition column for writes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators.merge import insert_if_absent


def quality_pairs(df: DataFrame, cpf_col: str = "cpf", phone_col: str = "telefone") -> DataFrame:
    """C25 gates: phone = last 11 digits, CPF masked; both present with
    lengths 11 and 14; distinct pairs."""
    out = df.select(S.cpf_mask(F.col(cpf_col)).alias("cliente_id"), S.last11(F.col(phone_col)).alias("telefone_id"))
    return (out.dropna(subset=["cliente_id", "telefone_id"])
            .filter((F.length("telefone_id") == 11) & (F.length("cliente_id") == 14)).distinct())


def load_client_phones(existing: dict[str, DataFrame], incoming: DataFrame) -> dict[str, DataFrame]:
    """K4 into three tables (client, phone, client-phone): insert-if-absent."""
    pairs = quality_pairs(incoming)
    return {
        "cliente": insert_if_absent(existing["cliente"], pairs.select(F.col("cliente_id").alias("id")).distinct(), ["id"]),
        "telefone_scoring": insert_if_absent(existing["telefone_scoring"],
                                             pairs.select(F.col("telefone_id").alias("id")).distinct(), ["id"]),
        "cliente_telefone": insert_if_absent(existing["cliente_telefone"], pairs, ["cliente_id", "telefone_id"]),
    }


def contact_history(log: DataFrame, users: DataFrame, excluded_logins: list[str], start: str | None = None,
                    end: str | None = None) -> DataFrame:
    """C26 + J27: client-related contacts with the phone parsed from the
    text, in ``[start, end]``; contacts by excluded logins — and those with
    no user, since ``NOT IN`` drops NULL — are left out."""
    t = log.filter(F.col("relacao") == "cliente")
    if start:
        t = t.filter(F.col("dataregistro") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        t = t.filter(F.col("dataregistro") <= F.lit(end).cast("timestamp_ntz"))
    u = users.filter(~F.col("login").isin(*excluded_logins)).select(F.col("id").alias("usuario_id"))
    t = t.join(u, "usuario_id")
    raw_phone = S.phone_from_text(F.col("texto"))
    return t.select(
        F.col("id").alias("telemarketing_id"), S.cpf_mask(F.col("relacao_id")).alias("cliente_id"),
        S.last11(raw_phone).alias("telefone_id"),
        F.concat(F.lit("STATUS "), F.col("status_telemarketing_id").cast("string")).alias("status_tabulacao"),
        F.col("dataregistro").alias("data_tabulacao"),
        F.date_format("dataregistro", "yyyy-MM").alias("mes"))
