"""Lead engine: histories, recurrent leads, last simulations, classification
rules, daily/remarketing lead sets and enrichment (W1-W5, A5, A16, A23, A25,
P2, P7, J3, J6, J8, J26, C1-C8, C17-C19).

All reference-time logic takes ``as_of`` (a ``TIMESTAMP_NTZ`` literal string
or Column).  Rules are ordered ``F.when`` chains: one fused projection, no
row-at-a-time Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S
from ledgerlens.operators.skew import latest_per_key, top_k_per_key

# Channel lists of the daily reports.
RECOMMENDED_CHANNELS = ["C2C", "APROVADO NÃO EFETIVADO", "SIMULAÇÃO DIGITAL - C2C",
                        "C2C NÃO CONVERTIDO", "C2C - NAO CORRENTISTA NOVO"]
FORBIDDEN_CHANNELS = ["QUITADOS - C2C", "LIQUIDANTES - C2C", "Quitados", "Liquidantes"]
# Ruler answers that make a lead actionable / valid.
ACTIONABLE_RULER = ["SIM", "NAO TESTADO", "ERRO MODELO"]
VALID_RULER = ["SIM", "NAO TESTADO"]
VALID_TICKETS = ["BAIXO", "MÉDIO"]
ENRICHABLE_TICKETS = ["BAIXO", "MÉDIO", "ALTO", "MUITO ALTO"]


def _ts(as_of) -> Column:
    return D.ts_ntz(as_of)


# ------------------------------------------------------------------ histories

def phone_history(leads: DataFrame, as_of) -> DataFrame:
    """A5: arrivals per phone: total, last 3 months, last year (partial agg)."""
    t = _ts(as_of)
    dc = F.col("data_chegada")
    return leads.groupBy("telefone").agg(
        F.count(F.lit(1)).cast("long").alias("qtd_total_historico"),
        F.sum(F.when(dc >= t - F.expr("INTERVAL 3 MONTHS"), 1).otherwise(0)).cast("long").alias("qtd_3_meses"),
        F.sum(F.when(dc >= t - F.expr("INTERVAL 1 YEAR"), 1).otherwise(0)).cast("long").alias("qtd_1_ano"),
    )


def recurrent_leads(leads: DataFrame, as_of, days: int = 30, channel: str = "CRM") -> DataFrame:
    """Latest lead of each phone that arrived more than once, with the
    previous arrival and day gap, when the latest came via ``channel`` within
    ``days`` days of ``as_of``.  The channel test applies after ranking.

    Formulated as partial aggregates instead of three windows over the phone
    (a hot phone would otherwise sit whole in one task): count and latest row
    via ``max(struct)``; the previous arrival is the maximum over the rows
    other than the latest, computed only for the phones that survive.
    """
    base = leads.filter(F.col("telefone").isNotNull() & (F.col("telefone") != ""))
    payload = ["id", "nome", "data_chegada", "valor", "ano", "tipo_envio"]
    counts = base.groupBy("telefone").agg(F.count("id").cast("long").alias("qtd_total_historico"))
    top = latest_per_key(base, ["telefone"], ["data_chegada", "id"], payload)
    cand = (top.join(counts, "telefone")
            .filter((F.col("qtd_total_historico") > 1) & (F.col("tipo_envio") == channel)
                    & (F.col("data_chegada") >= F.to_date(_ts(as_of)) - F.expr(f"INTERVAL {days} DAYS"))))
    others = (base.select("telefone", F.col("id").alias("_oid"), F.col("data_chegada").alias("_odc"))
              .join(cand.select("telefone", F.col("id").alias("_top_id")), "telefone")
              .filter(F.col("_oid") != F.col("_top_id"))
              .groupBy("telefone").agg(F.max("_odc").alias("data_simulacao_anterior")))
    out = cand.join(others, "telefone", "left")
    return out.select(
        "id", "telefone", "nome",
        F.col("data_chegada").alias("data_ultima_simulacao"),
        "data_simulacao_anterior",
        F.datediff(F.col("data_chegada"), F.col("data_simulacao_anterior")).alias("diferenca_dias"),
        "qtd_total_historico", "valor", "ano",
        F.when(F.col("valor").between(30000, 60000), 1).otherwise(0).alias("flag_30k_60k"),
        F.when(F.substring("ano", 1, 4) >= "2016", 1).otherwise(0).alias("flag_pos_2016"),
    )


def last_simulations(leads: DataFrame, exclude_ids: DataFrame | None = None, k: int = 3) -> DataFrame:
    """W4 + A16: the last three simulations per phone as ``veiculo - ano - valor``
    text, pivoted to three columns (conditional max).  Top-k is two-phase
    (salted), so a hot phone is never ranked in a single task."""
    base = leads
    if exclude_ids is not None:
        base = base.join(exclude_ids.select("id"), "id", "left_anti")
    order = [F.col("data_chegada").desc(), F.col("data_insercao").desc(), F.col("id").desc()]
    top = top_k_per_key(base.select("id", "telefone", "veiculo", "ano", "valor", "data_chegada", "data_insercao"),
                        ["telefone"], order, k, "id")
    txt = S.concat_strict(F.col("veiculo"), F.lit(" - "), F.col("ano"), F.lit(" - "), F.col("valor").cast("string"))
    names = ["ultima_simulacao", "penultima_simulacao", "antepenultima_simulacao"]
    return top.groupBy("telefone").agg(*[F.max(F.when(F.col("rn") == i + 1, txt)).alias(n)
                                         for i, n in enumerate(names[:k])])


def max_fipe_difference(leads: DataFrame) -> DataFrame:
    """A25 + J8: max reference value by vehicle and ``COALESCE(max, valor) - valor``.

    The per-vehicle maximum is a partial aggregate joined back on the vehicle."""
    return _with_fipe_difference(leads, leads)


def _with_fipe_difference(rows: DataFrame, all_leads: DataFrame) -> DataFrame:
    mx = (all_leads.filter(F.col("valor_fipe").isNotNull()).groupBy("veiculo")
          .agg(F.max("valor_fipe").alias("max_valor_fipe")))
    j = rows.join(mx, "veiculo", "left")
    return j.withColumn("diferenca_fipe", F.coalesce(F.col("max_valor_fipe"), F.col("valor")) - F.col("valor"))


def leads_to_enrich(leads: DataFrame, enrichment: DataFrame) -> DataFrame:
    """P2 + J3 + J6 + J8: unsent, unenriched, ruler not tested, complete leads of
    the latest arrival instant, with the max-FIPE difference; then the phone
    cleaning of P9 (digits, 10-11 long)."""
    latest = leads.agg(F.max("data_chegada")).scalar()  # J6: scalar subquery
    base = (leads.withColumn("classificacao_ticket", S.ticket_class(F.col("valor")))
            .join(enrichment.select(F.col("negociacao_id").alias("id")), "id", "left_anti")
            .filter(F.col("enviado").isNull() & F.col("telefone").isNotNull()
                    & (F.col("abriu_regua") == "NAO TESTADO")
                    & ~F.lower(F.col("canal")).contains("seguro")
                    & ~F.lower(F.col("canal")).contains("quitados")
                    & F.col("ano").isNotNull() & F.col("veiculo").isNotNull() & F.col("marca").isNotNull()
                    & F.col("valor").isNotNull()
                    & F.upper(F.col("classificacao_ticket")).isin(*ENRICHABLE_TICKETS)
                    & F.col("tipo_veiculo").isin("MOTO", "CARRO")
                    & (F.col("data_chegada") == latest)))
    # the max is over all leads of the vehicle, not only the eligible ones
    out = _with_fipe_difference(base, leads)
    tel = S.digits(F.col("telefone"))
    return (out.withColumn("telefone", tel)
            .filter(F.length("telefone").between(10, 11)))


# ------------------------------------------------------------------ rules

def within_two_business_days(arrival, as_of) -> Column:
    """``busday_count(date(arrival), date(as_of)) <= 2``; NULL arrival -> False."""
    return F.when(F.col(arrival).isNull(), F.lit(False)).otherwise(
        D.business_days_between(F.to_date(arrival), F.to_date(_ts(as_of))) <= 2)


def _upper_txt(c: str) -> Column:
    # str(x).upper() of the reference: NULL renders as NONE (never in a list)
    return F.coalesce(F.upper(F.col(c).cast("string")), F.lit("NONE"))


def disqualified() -> Column:
    """Phone NULL, or more than 10 arrivals in 3 months, or > 5 own-store proposals."""
    return (F.col("telefone").isNull() | (F.col("qtd_3_meses") > 10)
            | (F.coalesce(F.col("propostas_enviadas_minha_loja"), F.lit(0)) > 5))


def actionable() -> Column:
    """Not sent and ruler in SIM / NAO TESTADO / ERRO MODELO."""
    return F.col("enviado").isNull() & F.upper(F.trim(F.coalesce(F.col("abriu_regua"), F.lit("NONE")))).isin(*ACTIONABLE_RULER)


def valid_lead() -> Column:
    """Not sent, ticket BAIXO/MÉDIO, ruler SIM/NAO TESTADO."""
    return (F.col("enviado").isNull() & _upper_txt("classificacao_ticket").isin(*VALID_TICKETS)
            & _upper_txt("abriu_regua").isin(*VALID_RULER))


def priority_one_complete() -> Column:
    """C4: the priority-1 completeness check."""
    present = (F.col("telefone").isNotNull() & F.col("cpf").isNotNull() & F.col("data_nascimento").isNotNull()
               & F.col("ano").isNotNull() & F.col("veiculo").isNotNull() & F.col("marca").isNotNull())
    est = F.upper(F.col("estado").cast("string"))
    canal = F.lower(F.coalesce(F.col("canal"), F.lit("none")))
    return (present & F.col("estado").isNotNull() & ~est.isin("ND", "NAN")
            & F.col("semelhanca_nomes").isNotNull() & (F.col("semelhanca_nomes") >= 100)
            & ~canal.contains("seguro") & ~canal.contains("quitados")
            & F.col("valor").isNotNull() & (F.col("valor") > 0)
            & _upper_txt("tipo_veiculo").isin("MOTO", "CARRO"))


def priority_current(as_of) -> Column:
    """Current priority rule: 10 disqualified; 1 APROVADO / 2 C2C for valid
    leads valued 10k-40k with model year within 8 years; 3 recent; else 10."""
    recent = within_two_business_days("data_chegada", as_of)
    canal = F.upper(F.trim(F.coalesce(F.col("canal"), F.lit(""))))
    ano = F.substring(F.col("ano").cast("string"), 1, 4).try_cast("int")
    year = F.year(_ts(as_of))
    valido = (valid_lead() & F.col("valor").isNotNull() & F.col("valor").between(10000, 40000)
              & ano.isNotNull() & ano.between(year - 8, year))
    return (F.when(F.col("desclassificado"), F.lit(10))
            .when(recent & valido & canal.contains("APROVADO"), F.lit(1))
            .when(recent & valido & canal.contains("C2C"), F.lit(2))
            .when(recent, F.lit(3)).otherwise(F.lit(10)))


def _recovery(as_of) -> Column:
    secs = D.elapsed_seconds(_ts(as_of), F.col("data_insercao"))
    return (within_two_business_days("data_chegada", as_of) & F.col("veiculo").isNotNull()
            & F.col("data_insercao").isNotNull() & (secs >= 10800) & (_upper_txt("abriu_regua") != "NAO"))


def priority_base(as_of) -> Column:
    """C6 (base cascade)."""
    recent = within_two_business_days("data_chegada", as_of)
    abriu = _upper_txt("abriu_regua")
    ticket = _upper_txt("classificacao_ticket")
    genero = F.upper(F.trim(F.coalesce(F.col("genero"), F.lit("NONE"))))
    tipo = F.upper(F.trim(F.coalesce(F.col("tipo_veiculo"), F.lit("NONE"))))
    return (F.when(F.col("desclassificado"), F.lit(10))
            .when(valid_lead() & recent & (F.col("qtd_3_meses") == 2), F.lit(3))
            .when((genero == "M") & (tipo == "MOTO") & recent, F.lit(5))
            .when((tipo == "MOTO") & recent & valid_lead(), F.lit(7))
            .when(priority_one_complete() & valid_lead() & recent & (abriu != "ERRO MODELO"), F.lit(1))
            .when((abriu == "ERRO MODELO") & recent & ticket.isin(*VALID_TICKETS)
                  & (F.col("semelhanca_nomes") == 100), F.lit(4))
            .when(valid_lead() & recent, F.lit(2))
            .when(_recovery(as_of), F.lit(6))
            .otherwise(F.lit(10)))


def priority_by_ticket(as_of) -> Column:
    """C6 (by ticket value)."""
    recent = within_two_business_days("data_chegada", as_of)
    v = F.col("valor").cast("double")
    return (F.when(F.col("desclassificado"), F.lit(10))
            .when(actionable() & recent & v.isNotNull() & (v >= 10000) & (v <= 40000), F.lit(1))
            .when(actionable() & recent & v.isNotNull() & (v > 40000) & (v <= 80000), F.lit(2))
            .when(_recovery(as_of), F.lit(6))
            .otherwise(F.lit(10)))


def priority_by_audience(as_of) -> Column:
    """C6 (gender x vehicle type)."""
    recent = within_two_business_days("data_chegada", as_of)
    genero = F.upper(F.trim(F.coalesce(F.col("genero"), F.lit("NONE"))))
    tipo = F.upper(F.trim(F.coalesce(F.col("tipo_veiculo"), F.lit("NONE"))))
    act = actionable() & recent
    return (F.when(F.col("desclassificado"), F.lit(10))
            .when(act & (genero == "M") & (tipo == "MOTO"), F.lit(1))
            .when(act & (genero == "F") & (tipo == "MOTO"), F.lit(2))
            .when(act & (genero == "M") & (tipo == "CARRO"), F.lit(3))
            .when(act & (genero == "F") & (tipo == "CARRO"), F.lit(4))
            .when(act & (F.col("qtd_3_meses") == 2), F.lit(5))
            .when(_recovery(as_of), F.lit(6))
            .otherwise(F.lit(10)))


def lead_type(as_of) -> Column:
    """C7 (rule in use): sent leads keep their type; DESCARTE when
    disqualified; SQL/MQL for priorities 1-5 actionable and recent;
    RECUPERACAO for priority 6; else DESCARTE."""
    abriu = F.upper(F.trim(F.coalesce(F.col("abriu_regua"), F.lit("NONE"))))
    recent = within_two_business_days("data_chegada", as_of)
    return (F.when(F.col("enviado").isNotNull(), F.col("tipo_lead"))
            .when(F.col("desclassificado"), F.lit("DESCARTE"))
            .when(F.col("prioridade").isin(1, 2, 3, 4, 5) & actionable() & recent,
                  F.when(abriu == "SIM", F.lit("SQL"))
                  .when(abriu.isin("NAO TESTADO", "ERRO MODELO"), F.lit("MQL"))
                  .otherwise(F.lit("DESCARTE")))
            .when(F.col("prioridade") == 6, F.lit("RECUPERACAO"))
            .otherwise(F.lit("DESCARTE")))


def lead_type_valid(as_of) -> Column:
    """C7 (second rule): as ``lead_type``, but priority 4 with a model error is
    MQL at any age, priorities 1-5 ask for a valid lead instead of an
    actionable one, and 7 is RECUPERACAO as well."""
    abriu = _upper_txt("abriu_regua")
    recent = within_two_business_days("data_chegada", as_of)
    return (F.when(F.col("enviado").isNotNull(), F.col("tipo_lead"))
            .when(F.col("desclassificado"), F.lit("DESCARTE"))
            .when((F.col("prioridade") == 4) & (abriu == "ERRO MODELO"), F.lit("MQL"))
            .when(F.col("prioridade").isin(1, 2, 3, 4, 5) & valid_lead() & recent,
                  F.when(abriu == "SIM", F.lit("SQL")).when(abriu == "NAO TESTADO", F.lit("MQL")).otherwise(F.lit("DESCARTE")))
            .when(F.col("prioridade").isin(6, 7), F.lit("RECUPERACAO"))
            .otherwise(F.lit("DESCARTE")))


def eligible() -> Column:
    """C8 eligibility flag."""
    return (_upper_txt("abriu_regua").isin(*ACTIONABLE_RULER)
            & _upper_txt("classificacao_ticket").isin(*VALID_TICKETS))


def classification_input(leads: DataFrame, enrichment: DataFrame, as_of, days: int = 15, history: DataFrame | None = None) -> DataFrame:
    """C8 scan: leads of the last ``days`` days joined to their enrichment and
    to the phone history (left, zero-filled).  The history is aggregated over
    all leads (partial aggregate), unless it is given, then joined on the
    phone."""
    hist = phone_history(leads, as_of) if history is None else history
    t = _ts(as_of)
    recent = leads.filter(F.col("data_chegada") >= t - F.expr(f"INTERVAL {days} DAYS"))
    enr = enrichment.select(F.col("negociacao_id").alias("id"), "cpf", F.col("nome").alias("nome_cadastro"),
                            "data_nascimento", F.col("semelhanca").alias("semelhanca_nomes"), "genero")
    j = recent.join(enr, "id").join(hist, "telefone", "left")
    return j.select(
        "*",
        S.ticket_class(F.col("valor")).alias("classificacao_ticket"),
        S.state_by_phone(F.col("telefone")).alias("estado"),
        F.lit(None).cast("string").alias("tipo_lead"),
    ).fillna(0, ["qtd_3_meses", "qtd_1_ano", "qtd_total_historico"])


def classify(df: DataFrame, as_of) -> DataFrame:
    """C1, C5, C7 and the eligibility flag, in the reference's order (later
    rules read earlier columns); one fused projection."""
    return (df.withColumn("desclassificado", disqualified())
            .withColumn("prioridade", priority_current(as_of))
            .withColumn("tipo_lead", lead_type(as_of))
            .withColumn("elegivel", eligible()))


def classification_summary(classified: DataFrame) -> DataFrame:
    """Totals, disqualified, eligible and count per priority (one row per
    priority, totals repeated)."""
    per = classified.groupBy("prioridade").agg(
        F.count(F.lit(1)).cast("long").alias("qtd"),
        F.sum(F.col("desclassificado").cast("int")).cast("long").alias("_d"),
        F.sum(F.col("elegivel").cast("int")).cast("long").alias("_e"))
    # totals over the per-priority rows (a handful of rows: one small window)
    w = Window.partitionBy()
    return per.select("prioridade", "qtd", F.sum("qtd").over(w).cast("long").alias("total"),
                      F.sum("_d").over(w).cast("long").alias("desclassificados"),
                      F.sum("_e").over(w).cast("long").alias("elegiveis"))


# ------------------------------------------------------------------ daily sets

def whatsapp_flags(contacts: DataFrame) -> DataFrame:
    """Contact code 1 -> SIM, 0 -> NÃO, keyed by contact text."""
    lab = F.element_at(S.literal_map({1: "SIM", 0: "NÃO"}), F.col("whatsapp"))
    return contacts.select(F.col("contato"), "tipo_contato", lab.alias("whatsapp"))


def daily_leads(leads: DataFrame, enrichment: DataFrame, contacts: DataFrame, as_of,
                days: int = 15) -> DataFrame:
    """C17: recent unsent leads with enrichment, phone history (zero-filled)
    and WhatsApp flag.  The reference's seeded shuffle is an ordering of the
    output; callers order by ``md5(seed || id)`` at the sink when needed."""
    hist = phone_history(leads, as_of)
    t = _ts(as_of)
    enr = enrichment.select(F.col("negociacao_id").alias("id"), "cpf", F.col("nome").alias("nome_cadastro"),
                            "data_nascimento", F.col("semelhanca").alias("semelhanca_nomes"))
    base = (leads.filter((F.col("data_chegada") >= t - F.expr(f"INTERVAL {days} DAYS"))
                         & F.col("enviado").isNull() & F.col("telefone").isNotNull())
            .join(enr, "id").join(hist, "telefone", "left")
            .fillna(0, ["qtd_3_meses", "qtd_1_ano", "qtd_total_historico"]))
    wa = whatsapp_flags(contacts)
    return base.join(wa, base.telefone == wa.contato, "left").drop("contato")


def parse_offers(df: DataFrame, col: str = "ofertas_json", n: int = 3) -> DataFrame:
    """offers JSON -> entry, minimum and the first ``n`` instalments; bad
    JSON -> NULLs (``from_json`` in PERMISSIVE mode)."""
    schema = ("entradaRecomendada double, valorMinimo double, "
              "parcelas array<struct<quantidade:int, valor:double>>")
    parsed = F.from_json(F.col(col), schema)
    cols = [parsed.getField("entradaRecomendada").alias("entrada_recomendada"),
            parsed.getField("valorMinimo").alias("valor_minimo")]
    for i in range(n):
        item = parsed.getField("parcelas").getItem(i)
        cols += [item.getField("quantidade").alias(f"oferta_{i + 1}_quantidade"),
                 item.getField("valor").alias(f"oferta_{i + 1}_valor_parcela")]
    return df.select("*", *cols)


def enrich_daily(df: DataFrame, leads: DataFrame, sent_at) -> DataFrame:
    """Ticket class, model start year, days to send, offers JSON and the
    last three simulations of the phone (excluding the batch's own leads)."""
    out = (df.withColumn("valor", F.coalesce(F.col("valor"), F.lit(0).cast("decimal(18,2)")))
           .withColumn("classificacao_ticket", S.ticket_class(F.col("valor")))
           .withColumn("ano_inicio", S.model_year_first(F.col("ano")).try_cast("int"))
           .withColumn("data_hora_enviado", _ts(sent_at))
           .withColumn("dias_para_envio", D.elapsed_days(F.col("data_hora_enviado"), F.col("data_chegada"))))
    out = parse_offers(out)
    last = last_simulations(leads, exclude_ids=df.select("id"))
    return out.join(last, "telefone", "left")


def dashboard_refresh(leads: DataFrame, campaign_production: DataFrame, monthly_index: DataFrame,
                      gender_lookup: DataFrame | None, as_of) -> dict[str, DataFrame]:
    """The dashboard's four refreshes, in order: state from the phone
    for leads without one (J23), ticket class of vehicle finance (F49, DB
    form), gender from the first name of recent leads (J25), commission
    estimate (C9).  Each is a DataFrame of keyed updates for the merge."""
    from ledgerlens.operators.sla import estimated_commission
    from ledgerlens.sources.ingest import infer_gender
    est = leads.filter(F.col("telefone").isNotNull())
    if "estado" in leads.columns:
        est = est.filter(F.col("estado").isNull() | (F.col("estado") == ""))
    estados = est.select("id", S.state_by_phone(F.col("telefone")).alias("estado")).filter(F.col("estado").isNotNull())
    tickets = (campaign_production.select("id", S.ticket_class_db(F.col("valor_veiculo")).alias("classificacao_ticket"))
               .filter(F.col("classificacao_ticket").isNotNull()))
    out = {"estado": estados, "ticket": tickets,
           "comissao": estimated_commission(campaign_production, monthly_index)}
    if gender_lookup is not None:
        recent = leads.filter(F.to_date("data_chegada") >= F.date_sub(F.to_date(_ts(as_of)), 30))
        out["genero"] = (infer_gender(recent.select("id", "nome"), gender_lookup)
                         .filter(F.col("genero").isin("M", "F")).select("id", "genero"))
    return out
