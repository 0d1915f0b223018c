"""Insurance instalment status, commission estimate and payment SLA (C9-C12,
F43-F47, F55, A6, A7, J22, S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import calendar as C
from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S

PENDING = "PENDENTE PAGAMENTO"


def first_pending_instalment(instalments: DataFrame) -> DataFrame:
    """First pending instalment number per client (partial ``min``)."""
    return (instalments.filter(F.col("status") == PENDING)
            .groupBy("cpfcnpj_do_cliente")
            .agg(F.min(S.instalment_number(F.col("parcela"))).alias("primeira_parcela_devedora")))


def instalment_status(instalments: DataFrame, sales: DataFrame, ref_year: int, ref_month: int) -> DataFrame:
    """Expected instalment from the operation month to the reference
    month, compared with the first pending one: Em Dia / 1 Parcela Atrasada
    (Mês Atual) / N Parcelas Atrasadas.  Rows are distinct (A7)."""
    m = first_pending_instalment(instalments)
    op = D.parse_day_first(F.col("data_da_operacao"))
    base = (instalments.join(m, "cpfcnpj_do_cliente")
            .join(sales, sales.cliente_id == m.cpfcnpj_do_cliente, "left")
            .select("segurado", "cpfcnpj_do_cliente", "data_da_operacao", "primeira_parcela_devedora",
                    D.months_index(op, ref_year, ref_month).alias("parcela_esperada"), "telefone_venda")
            .distinct())
    p, e = F.col("primeira_parcela_devedora"), F.col("parcela_esperada")
    status = (F.when(p > e, F.lit("Em Dia"))
              .when(p == e, F.lit("1 Parcela Atrasada (Mês Atual)"))
              .when(p < e, F.concat((e - p + 1).cast("string"), F.lit(" Parcelas Atrasadas"))))
    return base.withColumn("situacao_do_cliente", status)


def estimated_commission(production: DataFrame, monthly_index: DataFrame) -> DataFrame:
    """C9/F55 + J22: commission estimate per vehicle-finance contract.

    The month-key join is an equi-join on ``yyyy-MM``; the index table has
    one row per month (bounded by the calendar), so it is broadcast."""
    p = production.withColumn("ano_mes", F.date_format("data_contrato", "yyyy-MM"))
    j = p.join(F.broadcast(monthly_index), "ano_mes")
    v = F.col("valor_veiculo").cast("double")
    cms = S.leading_int(F.col("regra")).cast("double") * F.lit(1.2) / F.lit(100.0)
    ila = F.col("pcila_txa") / F.lit(100.0)
    txa_raw = v * cms - v * cms * ila
    plu_raw = F.when(F.col("flag_estudo") == "N", v * (cms * F.lit(0.66)) - v * (cms * F.lit(0.66)) * ila).otherwise(F.lit(0.0))
    repasse = F.when(F.col("origem_venda") == "PARCEIRO", v * F.lit(0.015)).otherwise(F.lit(0.0))
    # MySQL rounds exact decimals half-up; round on a decimal cast (trap T4)
    r2 = lambda x: F.round(x.cast("decimal(38,10)"), 2).cast("double")
    return j.select("id", "pcila_txa",
                    r2(txa_raw).alias("comissao_estimada_txa"),
                    r2(plu_raw).alias("comissao_estimada_plu"),
                    (r2(txa_raw + plu_raw) - repasse).alias("comissao_estimada_total"))


# ------------------------------------------------------------------ payment SLA

# Example SLA configuration in the shape of the reference's per-bank JSON
# (the real file is not shipped); ``sla_rules`` accepts any such mapping or
# a JSON file read with ``ingest.read_json_documents``.
DEFAULT_SLA = {
    "BANCO SANTANDER": {"tipo_sla": "dias_uteis", "dias": 3, "usar_dias_uteis": True,
                        "regras_extras": {"data_limite": 25, "acao_pos_limite": "adicionar_dias"}},
    "BANCO PAN": {"tipo_sla": "dias_corridos", "dias": 5,
                  "regras_extras": {"dia_envio_proposta": {"sexta": {"tipo_sla": "dias_uteis", "dias": 2}}}},
    "BANCO C6": {"tipo_sla": "dia_semana", "dia_semana": "quarta"},
    "SABEMI": {"tipo_sla": "semanal", "intervalo_semanas": 2,
               "regras_extras": {"tipo_operacao": {"REFIN": {"tipo_sla": "mensal",
                                                              "mensal": {"ativo": True, "dia_limite": 10}}}}},
    "BANCO DO BRASIL": {"tipo_sla": "mensal", "dia_limite": 16,
                        "regras_extras": {"data_limite": 28, "acao_pos_limite": "adiar_pagamento"}},
}
WEEKDAY_INDEX = {"segunda": 0, "terça": 1, "terca": 1, "quarta": 2, "quinta": 3, "sexta": 4}
FLAT = ["tipo_sla", "dias", "usar_dias_uteis", "dias_semana_mask", "intervalo_semanas", "dia_limite"]
RULE_SCHEMA = ("banco string, nivel string, chave string, tipo_sla string, dias int, usar_dias_uteis boolean, "
               "dias_semana_mask int, intervalo_semanas int, dia_limite int, data_limite int, acao_pos_limite string, "
               "mensal_ativo boolean, mensal_dia_limite int")


def _mask(rule: dict):
    if "dia_semana" in rule:
        w = WEEKDAY_INDEX.get(str(rule["dia_semana"]).lower())
        return 0 if w is None else 1 << w
    if "dias_semana" in rule:
        return sum(1 << WEEKDAY_INDEX[d.lower()] for d in rule["dias_semana"] if d.lower() in WEEKDAY_INDEX)
    return None


def _flat(banco, nivel, chave, rule: dict, extras: dict | None = None):
    extras = extras or {}
    mensal = rule.get("mensal", extras.get("mensal", {})) or {}
    return (banco, nivel, chave, rule.get("tipo_sla"), rule.get("dias"), rule.get("usar_dias_uteis"), _mask(rule),
            rule.get("intervalo_semanas"), rule.get("dia_limite"), extras.get("data_limite"),
            extras.get("acao_pos_limite"), mensal.get("ativo"), mensal.get("dia_limite"))


def sla_rules(spark, config: dict = DEFAULT_SLA):
    """The SLA config normalised to one row per (bank, level, key):
    level ``base``, ``operacao`` (key = operation type) or ``envio`` (key =
    weekday name).  A configuration table: its size is the config's."""
    rows = []
    for banco, rule in config.items():
        extras = rule.get("regras_extras", {})
        rows.append(_flat(banco, "base", None, rule, extras))
        for op, r in extras.get("tipo_operacao", {}).items():
            rows.append(_flat(banco, "operacao", op, r))
        for day, r in extras.get("dia_envio_proposta", {}).items():
            rows.append(_flat(banco, "envio", day, r))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _prefixed(rules: DataFrame, level: str, prefix: str, key_name: str | None) -> DataFrame:
    r = rules.filter(F.col("nivel") == level)
    cols = [F.col("banco").alias("_banco"), F.lit(True).alias(prefix + "present")]
    if key_name:
        cols.append(F.col("chave").alias(key_name))
    cols += [F.col(c).alias(prefix + c) for c in rules.columns if c not in ("banco", "nivel", "chave")]
    return r.select(*cols)


def longest_shift(rules: DataFrame) -> int:
    """Calendar days that the longest rule may reach past its date.  The rules
    are a configuration table: one small row comes back.  A business day is
    at most two calendar days of a long span (five in seven are weekdays, and
    holidays are few); the rest is room for a short one around holidays."""
    r = rules.agg(F.coalesce(F.max("dias"), F.lit(1)).alias("days"), F.coalesce(F.max("intervalo_semanas"), F.lit(1)).alias("weeks")).first()
    return 45 + 2 * max(1, r["days"]) + 7 * max(1, r["weeks"])


def expected_payment_date(contracts: DataFrame, rules: DataFrame, date_col: str = "dat_credito",
                          bank_col: str = "nom_banco", op_col: str = "tipo_operacao") -> DataFrame:
    """Expected commission payment date per contract.

    Precedence as in the reference: operation override (monthly ones return
    at once), the limit-day action (postpone -> NULL, add a day), the
    send-weekday override, the SLA kind, the monthly switch, and the
    limit-day action once more on the result (trap T18).  Rules are a
    broadcast configuration table; every calendar step is a broadcast
    equi-join on a bounded calendar (span of the data plus a margin)."""
    spark = contracts.sparkSession
    base = _prefixed(rules, "base", "b_", None)
    oper = _prefixed(rules, "operacao", "o_", "_op")
    envio = _prefixed(rules, "envio", "e_", "_edia")
    c = contracts.withColumn("_d0", F.to_date(F.col(date_col))).withColumn("_bank", F.trim(F.col(bank_col)))
    j = (c.join(F.broadcast(base), c._bank == base._banco, "left").drop("_banco")
         .join(F.broadcast(oper), (F.col("_bank") == oper._banco) & (F.col(op_col) == oper._op), "left")
         .drop("_banco", "_op"))
    has_rule = F.coalesce(F.col("b_present"), F.lit(False))
    oper_monthly = F.col("o_tipo_sla").isNotNull() & (
        (F.col("o_tipo_sla") == "mensal") | F.coalesce(F.col("o_mensal_ativo"), F.lit(False)))
    for f in FLAT:
        j = j.withColumn("r_" + f, F.coalesce(F.col("o_" + f), F.col("b_" + f)))
    lim, acao = F.col("b_data_limite"), F.col("b_acao_pos_limite")
    past = lim.isNotNull() & (F.dayofmonth("_d0") >= lim)
    j = j.withColumn("_postpone", has_rule & ~oper_monthly & past & (acao == "adiar_pagamento"))
    j = j.withColumn("_d1", F.when(past & (acao == "adicionar_dias"), F.date_add("_d0", 1)).otherwise(F.col("_d0")))
    j = j.withColumn("_dia", F.element_at(F.array(*[F.lit(d) for d in ("segunda", "terça", "quarta", "quinta",
                                                                        "sexta", "sabado", "domingo")]),
                                          F.weekday("_d1") + 1))
    j = j.join(F.broadcast(envio), (F.col("_bank") == envio._banco) & (F.col("_dia") == envio._edia), "left") \
         .drop("_banco", "_dia", "_edia")
    for f in FLAT:
        j = j.withColumn("r_" + f, F.coalesce(F.col("e_" + f), F.col("r_" + f)))

    # bounded calendar over the data's span and the longest shift of any rule
    span = c.agg(F.min("_d0").alias("_lo"), F.max("_d0").alias("_hi"))
    cal = C.calendar_for_span(span, longest_shift(rules))
    ords = cal.select(F.col("data").alias("_k"), F.col("ordinal").alias("_ord"))
    bdays = cal.filter("util").select(F.col("ordinal").alias("_ord2"), F.col("data").alias("_bday"))

    tipo = F.col("r_tipo_sla")
    dias = F.coalesce(F.col("r_dias"), F.lit(1))
    weeks = F.coalesce(F.col("r_intervalo_semanas"), F.lit(1))
    # the date whose business successor is wanted, and how many business days
    j = j.withColumn("_bd_from", F.when(~has_rule, F.col("_d0"))
                     .when((tipo == "dias_uteis") & F.coalesce(F.col("r_usar_dias_uteis"), F.lit(True)), F.col("_d1"))
                     .when(tipo == "semanal", F.date_add("_d1", weeks * 7))
                     .when(tipo.isin("dias_corridos", "dias_uteis", "dia_semana", "dia_semana_multiplo", "mensal"),
                           F.lit(None).cast("date"))
                     .otherwise(F.col("_d1")))
    j = j.withColumn("_bd_n", F.when(has_rule & (tipo == "dias_uteis"), dias).otherwise(F.lit(1)))
    j = (j.join(F.broadcast(ords), j._bd_from == ords._k, "left")
         .join(F.broadcast(bdays), F.col("_ord") + F.col("_bd_n") == F.col("_ord2"), "left")
         .drop("_k", "_ord", "_ord2"))
    # next allowed weekday on/after _d1: per weekday w (Mon-Fri) the next
    # non-holiday date with that weekday, then the least over the mask's bits
    wfol = Window.orderBy("data").rowsBetween(0, Window.unboundedFollowing)
    wnext = cal.select(F.col("data").alias("_wk"), *[
        F.min(F.when((F.col("dia_semana") == wd) & ~F.col("feriado"), F.col("data"))).over(wfol).alias(f"_n{wd}")
        for wd in range(5)])
    j = j.join(F.broadcast(wnext), j._d1 == wnext._wk, "left").drop("_wk")
    mask = F.col("r_dias_semana_mask")
    j = j.withColumn("_next", F.least(*[F.when(F.shiftright(mask, wd).bitwiseAND(F.lit(1)) == 1, F.col(f"_n{wd}"))
                                        for wd in range(5)]))

    month_lim = F.coalesce(F.col("r_dia_limite"), F.lit(16))
    by_kind = (F.when(tipo == "dias_uteis",
                      F.when(F.coalesce(F.col("r_usar_dias_uteis"), F.lit(True)), F.col("_bday"))
                      .otherwise(F.date_add("_d1", dias)))
               .when(tipo == "dias_corridos", F.date_add("_d1", dias))
               .when(tipo.isin("dia_semana", "dia_semana_multiplo"), F.col("_next"))
               .when(tipo == "semanal", F.col("_bday"))
               .when(tipo == "mensal", D.monthly_cutoff(F.col("_d1"), month_lim))
               .otherwise(F.col("_bday")))
    mensal_switch = F.coalesce(F.col("b_mensal_ativo"), F.lit(False)) & (tipo != "mensal")
    by_kind = F.when(mensal_switch, D.monthly_cutoff(F.col("_d1"), F.coalesce(F.col("b_mensal_dia_limite"), F.lit(16)))) \
               .otherwise(by_kind)
    past1 = lim.isNotNull() & (F.dayofmonth("_d1") >= lim)
    final = (F.when(F.col("_d0").isNull(), F.lit(None).cast("date"))
             .when(~has_rule, F.col("_bday"))
             .when(oper_monthly, D.monthly_cutoff(F.col("_d0"),
                                                   F.coalesce(F.col("o_mensal_dia_limite"), F.lit(16))))
             .when(F.col("_postpone"), F.lit(None).cast("date"))
             .when(past1 & (acao == "adiar_pagamento"), F.lit(None).cast("date"))
             .when(past1 & (acao == "adicionar_dias"), F.date_add(by_kind, 1))
             .otherwise(by_kind))
    keep = contracts.columns
    return j.select(*keep, final.alias("data_esperada_pgto"))


def awaiting_payment(contracts: DataFrame, since: str, platform: str = "NOVA") -> DataFrame:
    """C11: contracts of one platform without a confirmation date, credited
    on or after ``since`` or not yet."""
    credited = F.col("dat_credito")
    return contracts.filter(F.col("dat_confirmacao").isNull() & (F.col("plataforma") == platform)
                            & (credited.isNull() | (credited >= F.lit(since).cast("timestamp_ntz"))))


def payment_status(df: DataFrame, as_of) -> DataFrame:
    """C11: AGUARDANDO RELATÓRIO (no date), PAGAR HOJE, ATRASO, EM DIA."""
    today = F.to_date(D.ts_ntz(as_of))
    e = F.col("data_esperada_pgto")
    return df.withColumn("status_pgto", F.when(e.isNull(), F.lit("AGUARDANDO RELATÓRIO"))
                         .when(e == today, F.lit("PAGAR HOJE"))
                         .when(e < today, F.lit("ATRASO")).otherwise(F.lit("EM DIA")))
