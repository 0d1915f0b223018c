"""Campaign batch: client resolution, blocked clients, lead payload,
rotating owner assignment and stale-assignment release (C22, C23, C24,
J5, J10, J14, J15, F32, W9, W10, K10-K12).

Everything is a join or an aggregate keyed by client; the rotating
assignment ranks *distinct clients* by their first appearance in the
batch's shuffle order with the md5-range-salted global rank (exact order,
no single-task window); per-client "last write wins" payloads are a
partial ``max(struct)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S
from ledgerlens.operators.assign import _md5_prefix_salt, ranked_consultants, shuffle_key
from ledgerlens.operators.skew import global_rank, latest_per_key

# Campaigns whose members are blocked from new batches.
BLOCKING_CAMPAIGNS = [9011, 9014, 15422]
DEFAULT_ENTRY = "R$ 0,00"
DEFAULT_MODEL = "ERRO MODELO"


def phone_index(clients: DataFrame) -> DataFrame:
    """(phone -> client) from both phone columns, one equi-join key;
    the greatest client id wins a shared phone (deterministic)."""
    long = (clients.select(F.col("idTabela"), S.strip_phone_punct(F.col("telefone")).alias("fone"))
            .unionByName(clients.select(F.col("idTabela"), S.strip_phone_punct(F.col("celular")).alias("fone")))
            .filter(F.col("fone").isNotNull() & (F.col("fone") != "")))
    return long.groupBy("fone").agg(F.max("idTabela").alias("cliente_fone"))


def resolve_clients(batch: DataFrame, clients: DataFrame) -> DataFrame:
    """Client by CPF first, else by phone (digits)."""
    b = (batch.withColumn("cpf_limpo", S.digits_or_null(F.col("cpf")))
         .withColumn("telefone_limpo", S.digits_or_null(F.col("telefone"))))
    by_cpf = clients.groupBy(F.col("id").alias("cpf_limpo")).agg(F.max("idTabela").alias("cliente_cpf"))
    j = b.join(by_cpf, "cpf_limpo", "left").join(
        phone_index(clients).withColumnRenamed("fone", "telefone_limpo"), "telefone_limpo", "left")
    return j.withColumn("cliente_id", F.coalesce("cliente_cpf", "cliente_fone")).drop("cliente_cpf", "cliente_fone")


def blocked_clients(members: DataFrame, campaigns: list[int] = BLOCKING_CAMPAIGNS) -> DataFrame:
    """Clients already in a blocking campaign (distinct ids)."""
    return members.filter(F.col("campanha_id").isin(*campaigns)).select("cliente_id").distinct()


def lead_payload(with_offers: bool = True, n_offers: int = 3):
    """F32: the CRM payload as JSON: ``{campo: {valor, mapeamento}}``; empty
    entry/minimum default to ``R$ 0,00``, a missing model to ``ERRO MODELO``;
    offers ``Nx de V`` only when both parts are present (3 offers, T19)."""
    def item(valor, mapeamento):
        return F.struct(valor.alias("valor"), F.lit(mapeamento).alias("mapeamento"))
    nome = F.coalesce(F.col("nome_cockpit"), F.lit(""))
    fields = [
        item(nome, "Nome Cockpit").alias("Nome Cockpit"),
        item(F.coalesce(S.first_name(F.col("nome_cockpit")), F.lit("")), "Primeiro Nome Cockpit").alias("Primeiro Nome Cockpit"),
        item(F.coalesce(F.col("veiculo"), F.lit("")), "Veículo").alias("Veículo"),
        item(F.coalesce(F.col("ano"), F.lit("")), "Ano").alias("Ano"),
        item(F.col("valor").cast("string"), "Valor").alias("Valor"),
        item(F.col("canal"), "Canal").alias("Canal"),
        item(F.col("semelhanca_nomes"), "Semelhança").alias("Semelhança"),
    ]
    if with_offers:
        fields += [
            item(F.coalesce(F.col("entrada_recomendada").cast("string"), F.lit(DEFAULT_ENTRY)), "Entrada").alias("Entrada Recomendada"),
            item(F.coalesce(F.col("valor_minimo").cast("string"), F.lit(DEFAULT_ENTRY)), "Valor Mínimo").alias("Valor Mínimo"),
            item(F.when(F.trim(F.col("modelo_selecionado")) != "", F.col("modelo_selecionado")).otherwise(F.lit(DEFAULT_MODEL)),
                 "Modelo Selecionado").alias("Modelo Selecionado"),
        ]
        for i in range(1, n_offers + 1):
            q, v = F.col(f"oferta_{i}_quantidade"), F.col(f"oferta_{i}_valor_parcela")
            txt = F.concat(q.cast("long").cast("string"), F.lit("x de "), v.cast("string"))
            fields.append(F.when(q.isNotNull() & v.isNotNull(), item(txt, f"Parcela_{i}")).alias(f"Oferta {i}"))
    return F.to_json(F.struct(*fields))


def campaign_batch(batch: DataFrame, clients: DataFrame, members: DataFrame, users: DataFrame,
                   with_offers: bool = True) -> DataFrame:
    # a batch without model texts has none
    if "modelo_selecionado" not in batch.columns:
        batch = batch.withColumn("modelo_selecionado", F.lit(None).cast("string"))
    return _campaign_batch(batch, clients, members, users, with_offers)


def _campaign_batch(batch: DataFrame, clients: DataFrame, members: DataFrame, users: DataFrame, with_offers: bool) -> DataFrame:
    """Resolve, drop blocked, last payload per client (W10), and the
    first-seen owner by rotation over the campaign users (W9)."""
    r = resolve_clients(batch, clients).filter(F.col("cliente_id").isNotNull())
    r = r.join(blocked_clients(members), "cliente_id", "left_anti")
    r = r.withColumn("_k", shuffle_key()).withColumn("dados_json", lead_payload(with_offers))
    last = latest_per_key(r, ["cliente_id"], ["_k"], ["dados_json"])
    first = r.groupBy("cliente_id").agg(F.min("_k").alias("_k"))
    ranked = global_rank(first, "_k", salt=_md5_prefix_salt("_k"), out="ordem")
    rc = ranked_consultants(users)
    n = rc.agg(F.count(F.lit(1))).scalar()
    owners = (ranked
              .withColumn("_idx", F.when(n > 0, F.pmod(F.col("ordem") - 1, n)))
              .join(rc, "_idx", "left")
              .select("cliente_id", "ordem", "usuario_id"))
    return owners.join(last, "cliente_id")


def stale_assignments(members: DataFrame, clients: DataFrame, leads: DataFrame, contacts_log: DataFrame,
                      campaign_id: int, as_of, contact_campaigns: list[int] = BLOCKING_CAMPAIGNS) -> DataFrame:
    """Members of a campaign whose lead (joined by phone digits) arrived
    more than one business day before ``as_of`` and who have no contact in
    the given campaigns; returns (cliente_id, lead id) to release."""
    m = members.filter(F.col("campanha_id") == campaign_id).select("cliente_id")
    cphone = clients.select(F.col("idTabela").alias("cliente_id"),
                            S.digits_or_null(S.first_contact("celular", "telefone")).alias("fone"))
    lp = leads.select("id", S.digits_or_null(S.strip_phone_punct(F.col("telefone"))).alias("fone"),
                      F.to_date("data_chegada").alias("chegada"))
    j = m.join(cphone, "cliente_id").join(lp, "fone").filter(F.col("chegada").isNotNull())
    j = j.filter(D.business_days_between(F.col("chegada"), F.to_date(D.ts_ntz(as_of))) > 1)
    contacted = (contacts_log.filter(F.col("campanha_id").isin(*contact_campaigns))
                 .select(F.col("relacao_id").alias("cliente_id")).distinct())
    return j.join(contacted, "cliente_id", "left_anti").select("cliente_id", "id")
