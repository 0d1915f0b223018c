"""Conversation funnel: CRM conversations joined to the lead that started them
and to campaign revenue, with flags, day buckets and categorical bins, then
lift tables and a daily cohort (C27, J9, J12, J13, A10-A17, F5, F6, F48-F53).

Scale notes: per-conversation message statistics, per-contact latest tag,
per-phone latest lead and per-phone revenue are all partial aggregates
(``max(struct)`` for the latest row) joined on their key — a phone or
contact with a huge history never lands whole in one task.  The lift table
is one grouping-sets aggregate (one Expand + one shuffle) instead of one
group-by per attribute; global rates are window sums over that small
aggregated result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators.skew import latest_per_key

# Bins of the funnel study (right-closed, as pandas.cut).
ANO_EDGES = [1900, 2005, 2010, 2015, 2020, 2026]
ANO_LABELS = ["< 2005", "2006-2010", "2011-2015", "2016-2020", "2021-2026"]
VALOR_EDGES = [0, 30000, 60000, 100000, 150000, 250000, float("inf")]
VALOR_LABELS = ["Ate 30k", "30k-60k", "60k-100k", "100k-150k", "150k-250k", "> 250k"]
IDADE_EDGES = [17, 25, 35, 45, 55, 65, 120]
IDADE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65", "> 65"]
SEMELHANCA_EDGES = [-1, 30, 60, 80, 95, 100]
SEMELHANCA_LABELS = ["0-30", "31-60", "61-80", "81-95", "96-100"]
# Tags that count as a conversion, attributes and pairs studied.
CONVERSION_TAGS = [30, 20, 15]
ATTRIBUTES = ["cat_ano", "cat_valor", "tipo_veiculo", "classificacao_ticket", "estado", "cat_idade",
              "cat_semelhanca", "genero", "canal"]
INTERACTIONS = [
    ["bucket", "cat_ano"], ["bucket", "cat_valor"], ["cat_ano", "cat_valor"],
    ["cat_idade", "cat_valor"], ["cat_ano", "classificacao_ticket"], ["estado", "cat_ano"],
    ["cat_idade", "cat_ano"], ["genero", "cat_ano"], ["genero", "cat_valor"],
    ["genero", "bucket"], ["genero", "tipo_veiculo"], ["genero", "cat_idade"],
    ["tipo_veiculo", "cat_ano"], ["tipo_veiculo", "cat_valor"],
]
RATE_FLOOR = 1e-9


def conversation_stats(messages: DataFrame) -> DataFrame:
    """A10: message count and first outbound non-notice time per conversation."""
    first_out = F.when((F.col("direcao") == "out") & (F.col("tipo").isNull() | (F.col("tipo") != "aviso")),
                       F.col("criado_em"))
    return messages.groupBy("atendimento_id").agg(
        F.count(F.lit(1)).cast("long").alias("total_mensagens"),
        F.min(first_out).alias("data_inicio"))


def latest_tag(tags: DataFrame, allowed=CONVERSION_TAGS) -> DataFrame:
    """Latest tag per contact among ``allowed`` (per-contact, trap T7)."""
    t = tags.filter(F.col("etiqueta_id").isin(*allowed))
    return latest_per_key(t, ["contato_id"], ["data_etiqueta", "etiqueta_id"], ["etiqueta_id"])


def crm_frame(conversations: DataFrame, contacts: DataFrame, messages: DataFrame, tags: DataFrame) -> DataFrame:
    """CRM side: conversations with contact text, stats and latest tag;
    only conversations with a first outbound message."""
    stats = conversation_stats(messages)
    c = conversations.join(contacts.select(F.col("id").alias("contato_id"), "contato"), "contato_id")
    c = c.join(stats, c.id == stats.atendimento_id, "left").drop("atendimento_id")
    c = c.join(latest_tag(tags), "contato_id", "left")
    return (c.withColumn("total_mensagens", F.coalesce(F.col("total_mensagens"), F.lit(0)).cast("long"))
            .filter(F.col("data_inicio").isNotNull())
            .select(F.col("id").alias("atendimento_id"), "contato_id", "contato", "data_inicio",
                    "total_mensagens", "etiqueta_id"))


LEAD_COLS = ["data_chegada", "ano", "valor", "tipo_veiculo", "classificacao_ticket", "estado", "genero",
             "semelhanca", "data_nascimento", "canal"]


def funnel_frame(crm: DataFrame, leads: DataFrame, enrichment: DataFrame, production: DataFrame) -> DataFrame:
    """C27 + J12 + J13: conversation -> latest lead of its phone (fallback on
    the phone without the ninth digit, right side deduped by latest arrival,
    trap T8) -> campaign revenue (same fallback, default 0), then flags,
    buckets and bins."""
    crm = (crm.withColumn("telefone", S.phone_digits(F.col("contato")))
           .withColumn("telefone_sem9", S.drop_ninth_digit(F.col("telefone"))))
    ck = (leads.join(enrichment.select(F.col("negociacao_id").alias("id"), "semelhanca", "data_nascimento", "genero"),
                     "id", "left")
          .withColumn("classificacao_ticket", S.ticket_class(F.col("valor")))
          .withColumn("estado", S.state_by_phone(F.col("telefone")))
          .withColumn("telefone", S.phone_digits(F.col("telefone")))
          .filter(F.col("telefone").isNotNull())
          .withColumn("telefone_sem9", S.drop_ninth_digit(F.col("telefone"))))
    order = ["data_chegada", "data_insercao", "id"]
    by_phone = latest_per_key(ck, ["telefone"], order, LEAD_COLS, prefix="a_")
    by_sem9 = latest_per_key(ck, ["telefone_sem9"], order, LEAD_COLS, prefix="b_")
    m = crm.join(by_phone, "telefone", "left").join(by_sem9, "telefone_sem9", "left")
    hit = F.col("a_data_chegada").isNotNull()
    for c in LEAD_COLS:
        m = m.withColumn(c, F.when(hit, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")))
    m = m.drop(*[f"a_{c}" for c in LEAD_COLS], *[f"b_{c}" for c in LEAD_COLS]).filter(F.col("data_chegada").isNotNull())

    prod = (production.filter((F.col("origem_venda") == "CAMPANHA") & F.col("data_cancelamento").isNull())
            .withColumn("telefone", S.phone_digits(F.col("telefone_cliente")))
            .withColumn("telefone_sem9", S.drop_ninth_digit(F.col("telefone"))))
    rev1 = (prod.filter(F.col("telefone").isNotNull()).groupBy("telefone")
            .agg(F.sum("valor_comissao").alias("_r1")))
    rev2 = (prod.filter(F.col("telefone_sem9").isNotNull()).groupBy("telefone_sem9")
            .agg(F.sum("valor_comissao").alias("_r2")))
    m = m.join(rev1, "telefone", "left").join(rev2, "telefone_sem9", "left")
    m = m.withColumn("receita_total", F.coalesce(F.col("_r1"), F.col("_r2"), F.lit(0)).cast("decimal(38,2)")).drop("_r1", "_r2")
    return add_funnel_features(m)


def add_funnel_features(m: DataFrame) -> DataFrame:
    """Flags, day buckets and categorical bins."""
    dias = F.datediff(F.to_date("data_inicio"), F.to_date("data_chegada"))
    ano = S.model_year_first(F.col("ano").cast("string")).try_cast("double")
    idade = F.floor(F.datediff(F.to_date("data_chegada"), F.col("data_nascimento")) / F.lit(365.25))
    return m.select(
        "*",
        (F.col("total_mensagens") >= 50).alias("mais_50"),
        (F.col("total_mensagens") >= 100).alias("mais_100"),
        (F.col("total_mensagens") >= 200).alias("mais_200"),
        F.col("etiqueta_id").isNotNull().alias("converteu_etiqueta"),
        dias.alias("dias_desde_chegada"),
        S.day_bucket(dias).alias("bucket"),
        F.when(F.col("total_mensagens") >= 50, _short_bucket(dias, "_50m")).alias("bucket_50"),
        F.when(F.col("total_mensagens") >= 100, _short_bucket(dias, "_100m")).alias("bucket_100"),
        ano.cast("int").alias("ano_inicio"),
        S.bins_right_closed(ano, ANO_EDGES, ANO_LABELS).alias("cat_ano"),
        S.bins_right_closed(F.col("valor"), VALOR_EDGES, VALOR_LABELS).alias("cat_valor"),
        S.bins_right_closed(idade, IDADE_EDGES, IDADE_LABELS).alias("cat_idade"),
        S.bins_right_closed(F.col("semelhanca"), SEMELHANCA_EDGES, SEMELHANCA_LABELS).alias("cat_semelhanca"),
    )


def _short_bucket(x: Column, suffix: str) -> Column:
    return (F.when(x.isNull(), F.lit(None).cast("string")).when(x < 0, F.lit("<D0" + suffix))
            .when(x == 0, F.lit("D0" + suffix)).when(x == 1, F.lit("D1" + suffix))
            .when(x == 2, F.lit("D2" + suffix)).otherwise(F.lit("D3+" + suffix)))


def _with_global_rates(grouped: DataFrame, set_cols: list[str]) -> DataFrame:
    """Global rates with a 1e-9 floor.  The groups of one grouping set
    partition all funnel rows, so summing a set's groups gives the global
    totals: a window over the (small) aggregated result, no extra scan and
    no join."""
    w = Window.partitionBy(*set_cols)
    vol = F.sum("volume").over(w).cast("double")
    out = grouped
    for c, n in [("casos_50", "50"), ("casos_100", "100"), ("casos_200", "200"), ("casos_etiqueta", "etiq")]:
        out = out.withColumn(f"tx_{n}", F.greatest(F.sum(c).over(w).cast("double") / vol, F.lit(RATE_FLOOR)))
    return out


def _measures():
    return [F.count(F.lit(1)).cast("long").alias("volume"),
            F.sum(F.col("mais_50").cast("int")).cast("long").alias("casos_50"),
            F.sum(F.col("mais_100").cast("int")).cast("long").alias("casos_100"),
            F.sum(F.col("mais_200").cast("int")).cast("long").alias("casos_200"),
            F.sum(F.col("converteu_etiqueta").cast("int")).cast("long").alias("casos_etiqueta"),
            F.sum("receita_total").cast("decimal(38,2)").alias("receita_gerada")]


def _rates(df: DataFrame) -> DataFrame:
    v = F.col("volume").cast("double")
    out = df
    for c, n in [("casos_50", "50"), ("casos_100", "100"), ("casos_200", "200"), ("casos_etiqueta", "etiq")]:
        out = (out.withColumn(f"por_mil_{n}", F.col(c).cast("double") / v * F.lit(1000.0))
               .withColumn(f"lift_{n}", (F.col(c).cast("double") / v) / F.col(f"tx_{n}")))
    return (out.withColumn("receita_por_lead", F.col("receita_gerada").cast("double") / v)
            .drop("tx_50", "tx_100", "tx_200", "tx_etiq"))


def lift_by_attribute(funnel: DataFrame, attributes=ATTRIBUTES) -> DataFrame:
    """A12 + A14: one grouping-sets pass over single attributes; NULL is a
    group of its own (``dropna=False``); rates unrounded (trap T4)."""
    cols = [F.col(a).cast("string").alias(a) for a in attributes]
    base = funnel.select(*cols, "mais_50", "mais_100", "mais_200", "converteu_etiqueta", "receita_total")
    agg = base.groupingSets([[a] for a in attributes], *attributes).agg(
        *_measures(), *[F.grouping(a).alias(f"_g_{a}") for a in attributes])
    name = None
    value = None
    for a in attributes:
        name = F.when(F.col(f"_g_{a}") == 0, F.lit(a)) if name is None else name.when(F.col(f"_g_{a}") == 0, F.lit(a))
        value = F.when(F.col(f"_g_{a}") == 0, F.col(a)) if value is None else value.when(F.col(f"_g_{a}") == 0, F.col(a))
    out = agg.select(name.alias("atributo"), value.alias("valor"), "volume", "casos_50", "casos_100", "casos_200",
                     "casos_etiqueta", "receita_gerada")
    return _rates(_with_global_rates(out, ["atributo"]).filter(F.col("volume") > 0))


def lift_by_interaction(funnel: DataFrame, pairs=INTERACTIONS, min_volume: int = 10) -> DataFrame:
    """Pairwise interaction lift in one grouping-sets pass, volume >= 10."""
    attrs = sorted({a for p in pairs for a in p})
    cols = [F.col(a).cast("string").alias(a) for a in attrs]
    base = funnel.select(*cols, "mais_50", "mais_100", "mais_200", "converteu_etiqueta", "receita_total")
    agg = base.groupingSets([list(p) for p in pairs], *attrs).agg(
        *_measures(), *[F.grouping(a).alias(f"_g_{a}") for a in attrs])
    n1 = v1 = n2 = v2 = None
    for a, b in pairs:
        cond = (F.col(f"_g_{a}") == 0) & (F.col(f"_g_{b}") == 0) & reduce_others(attrs, (a, b))
        n1 = F.when(cond, F.lit(a)) if n1 is None else n1.when(cond, F.lit(a))
        n2 = F.when(cond, F.lit(b)) if n2 is None else n2.when(cond, F.lit(b))
        v1 = F.when(cond, F.col(a)) if v1 is None else v1.when(cond, F.col(a))
        v2 = F.when(cond, F.col(b)) if v2 is None else v2.when(cond, F.col(b))
    out = agg.select(n1.alias("atributo_1"), n2.alias("atributo_2"), v1.alias("valor_1"), v2.alias("valor_2"),
                     "volume", "casos_50", "casos_100", "casos_200", "casos_etiqueta", "receita_gerada")
    out = _with_global_rates(out, ["atributo_1", "atributo_2"])
    return _rates(out.filter(F.col("volume") >= min_volume))


def reduce_others(attrs, pair) -> Column:
    cond = F.lit(True)
    for a in attrs:
        if a not in pair:
            cond = cond & (F.col(f"_g_{a}") == 1)
    return cond


def daily_cohort(funnel: DataFrame) -> DataFrame:
    """Per arrival day: totals, rates x100 and revenue per lead."""
    agg = funnel.groupBy(F.to_date("data_chegada").alias("dia")).agg(
        F.count(F.lit(1)).cast("long").alias("total_atendimentos"),
        F.sum(F.col("mais_50").cast("int")).cast("long").alias("atendimentos_50"),
        F.sum(F.col("mais_100").cast("int")).cast("long").alias("atendimentos_100"),
        F.sum(F.col("converteu_etiqueta").cast("int")).cast("long").alias("atendimentos_etiqueta"),
        F.sum("receita_total").cast("decimal(38,2)").alias("receita_total"))
    t = F.col("total_atendimentos").cast("double")
    return (agg.withColumn("taxa_50", F.col("atendimentos_50").cast("double") / t * F.lit(100.0))
            .withColumn("taxa_100", F.col("atendimentos_100").cast("double") / t * F.lit(100.0))
            .withColumn("taxa_etiqueta", F.col("atendimentos_etiqueta").cast("double") / t * F.lit(100.0))
            .withColumn("receita_por_lead", F.col("receita_total").cast("double") / t))


def lift_matrix(interaction: DataFrame, a: str, b: str, labels_b: list[str], value: str = "lift_100") -> DataFrame:
    """Pivot of one interaction's metric (rows ``a``, columns the known
    labels of ``b``) — explicit pivot values, so no extra distinct pass."""
    sub = interaction.filter((F.col("atributo_1") == a) & (F.col("atributo_2") == b))
    return sub.groupBy(F.col("valor_1").alias(a)).pivot("valor_2", labels_b).agg(F.first(value))
