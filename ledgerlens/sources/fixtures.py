"""Logical tables of the lead / commission domain derived from the driver tables.

Every derivation is a plain, deterministic column expression (modulo,
lpad, md5, CASE) so the DuckDB oracle can restate it independently in SQL
(see ``ledgerlens.plans.oracle_fixtures``).  All are lazy DataFrames: the
scan, the projection and any filter fuse into one stage and column pruning
reaches the parquet reader.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.sources.tables import read_table

# Reference times of the driver tables.
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-08-02 00:00:00"

# Bank names by banco_id (0..4).
BANK_NAMES = ["BANCO SANTANDER", "BANCO PAN", "BANCO DO BRASIL", "SABEMI", "BANCO C6"]

# Order priority -> product table of the new-vs-recurring report.
PRODUCT_TABLE_BY_PRIORITY = {
    "1-URGENT": "producao",
    "2-HIGH": "producao_cadastro_unico",
    "3-MEDIUM": "producao_fgts",
    "4-NOT SPECIFIED": "producao_banco_consig",
    "5-LOW": "producao_cp",
}

# Lead channel by event type.
CHANNEL_BY_EVENT = {
    "click": "APROVADO NÃO EFETIVADO",
    "view": "C2C",
    "purchase": "SIMULAÇÃO DIGITAL - C2C",
    "signup": "QUITADOS - C2C",
    "error": "SEGURO AUTO",
}

# Ruler answers by event_id % 4.
RULER_ANSWERS = ["SIM", "NAO", "NAO TESTADO", "ERRO MODELO"]


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _by_index(col, values: list):
    expr = None
    for i, v in enumerate(values):
        expr = F.when(col == i, F.lit(v)) if expr is None else expr.when(col == i, F.lit(v))
    return expr


def cpf_of(custkey) -> "F.Column":
    """Digits-only CPF (11 chars, zero padded) for a customer key."""
    return F.lpad(custkey.cast("string"), 11, "0")


def phone_of(key) -> "F.Column":
    """Mobile phone text ``(dd) 9nnnnnnnn`` for a user/customer key."""
    ddd = (F.lit(11) + F.pmod(key, F.lit(89))).cast("string")
    num = F.lpad(F.pmod(key * F.lit(7919), F.lit(100000000)).cast("string"), 8, "0")
    return F.concat(F.lit("("), ddd, F.lit(") 9"), num)


# ---------------------------------------------------------------- production

def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Internal production (``producao_cadastro_unico``): one contract per order."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        cpf_of(F.col("o_custkey")).alias("cliente_id"),
        F.pmod(k, F.lit(5)).alias("banco_id"),
        F.when(F.pmod(k, F.lit(7)) != 0, k.cast("string")).alias("numero_proposta"),
        F.when(F.pmod(k, F.lit(11)) != 0, F.concat(F.lit("CT"), k.cast("string"))).alias("numero_contrato"),
        F.col("o_orderdate").alias("data_contrato"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("data_cancelamento"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor_comissao"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor_liberado"),
        F.col("o_orderpriority").alias("produto"),
        F.concat(F.lit("CONVENIO BRAND#"), (F.pmod(F.col("o_custkey"), F.lit(25)) + 1).cast("string")).alias("convenio"),
    )


def product_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six product tables of the new-vs-recurring report.

    Five are orders split by priority; the card table is lineitem joined to
    its order, dated by ship date (``data_cartao``).
    """
    prod = production(spark, sf_dir).select("cliente_id", "data_contrato", "data_cancelamento", "produto")
    out = {name: prod.filter(F.col("produto") == pr).drop("produto")
           for pr, name in PRODUCT_TABLE_BY_PRIORITY.items()}
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    card = li.join(o, li.l_orderkey == o.o_orderkey).select(
        cpf_of(F.col("o_custkey")).alias("cliente_id"),
        F.col("l_shipdate").alias("data_cartao"),
        F.when(F.col("o_orderstatus") == "P", F.col("l_shipdate")).alias("data_cancelamento"),
    )
    out["producao_cartao"] = card
    return out


# ---------------------------------------------------------------- leads

def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead arrivals (``negociacao_cockpit``) from ``events``."""
    e = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    cents2 = (F.round(F.col("value") * 100).cast("long") * 2)
    pk = uid * 8 + F.pmod(eid, F.lit(8))  # phone key: ~8 arrivals per phone
    telefone = (F.when(F.pmod(pk, F.lit(37)) == 0, F.lit(None).cast("string"))
                .when(F.pmod(pk, F.lit(41)) == 0, F.lit(""))
                .otherwise(phone_of(pk)))
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    ofertas = F.when(F.pmod(eid, F.lit(10)) == 9, F.lit("{not json")).otherwise(F.concat(
        F.lit('{"entradaRecomendada": '), (k * 100).cast("string"),
        F.lit(', "valorMinimo": '), (k * 50).cast("string"),
        F.lit(', "parcelas": [{"quantidade": 12, "valor": '), (k * 10).cast("string"),
        F.lit('}, {"quantidade": 24, "valor": '), (k * 6).cast("string"),
        F.lit('}, {"quantidade": 36, "valor": '), (k * 4).cast("string"),
        F.lit("}]}")))
    return e.select(
        eid.alias("id"),
        uid.alias("user_id"),
        telefone.alias("telefone"),
        F.concat(F.lit("Cliente "), uid.cast("string")).alias("nome"),
        F.concat(F.lit("MODELO "), F.pmod(uid, F.lit(40)).cast("string")).alias("veiculo"),
        F.concat(F.lit("FIPE"), F.pmod(uid, F.lit(40)).cast("string")).alias("fipe"),
        F.concat(F.lit("MARCA "), F.pmod(uid, F.lit(12)).cast("string")).alias("marca"),
        F.concat((F.lit(2010) + F.pmod(eid, F.lit(16))).cast("string"), F.lit("/"),
                 (F.lit(2011) + F.pmod(eid, F.lit(16))).cast("string")).alias("ano"),
        cents2.cast("decimal(18,2)").alias("valor"),
        F.when(F.pmod(eid, F.lit(13)) != 0,
               (cents2 + F.pmod(eid, F.lit(10)) * 500).cast("decimal(18,2)")).alias("valor_fipe"),
        F.when(F.pmod(uid, F.lit(5)) == 0, F.lit("MOTO")).otherwise(F.lit("CARRO")).alias("tipo_veiculo"),
        _case(F.col("event_type"), CHANNEL_BY_EVENT).alias("canal"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("CRM")).otherwise(F.lit("SMS")).alias("tipo_envio"),
        F.when(F.pmod(eid, F.lit(3)) == 0, F.lit(1)).alias("enviado"),
        _by_index(F.pmod(eid, F.lit(4)), RULER_ANSWERS).alias("abriu_regua"),
        F.pmod(eid, F.lit(8)).cast("int").alias("propostas_enviadas_minha_loja"),
        F.pmod(eid, F.lit(5)).cast("int").alias("propostas_enviadas_outras_lojas"),
        ofertas.alias("ofertas_json"),
        F.col("ts").alias("data_chegada"),
        F.col("ts").alias("data_insercao"),
        F.when(F.pmod(eid, F.lit(7)) == 1, F.col("ts") + F.expr("INTERVAL 1 HOURS")).alias("data_hora_enviado"),
        F.when(F.pmod(eid, F.lit(6)) == 0, F.lit(1)).otherwise(F.lit(0)).alias("consultando"),
        F.when(F.pmod(eid, F.lit(6)) == 0,
               F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.pmod(eid, F.lit(20)).cast("int"))).alias("locked_at"),
    )


def lead_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead enrichment (``enriquecimento_lead``): one row per lead except
    ``event_id % 7 = 0``; name from the customer with the same key."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    uid = F.col("user_id")
    j = e.filter(F.pmod(F.col("event_id"), F.lit(7)) != 0).join(c, e.user_id == c.c_custkey, "left")
    return j.select(
        F.col("event_id").alias("negociacao_id"),
        F.when(F.pmod(uid, F.lit(11)) != 0, cpf_of(uid)).alias("cpf"),
        F.col("c_name").alias("nome"),
        F.when(F.pmod(uid, F.lit(3)) == 0, F.lit("M")).when(F.pmod(uid, F.lit(3)) == 1, F.lit("F")).alias("genero"),
        F.when(F.pmod(uid, F.lit(4)) == 0, F.lit(100)).otherwise(F.pmod(uid * 37, F.lit(101))).cast("int").alias("semelhanca"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(uid * 97, F.lit(15000)).cast("int")).alias("data_nascimento"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact registry (``contato_cliente``): one phone per customer key."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"),
        k.alias("cliente_id"),
        phone_of(k).alias("contato"),
        F.lit("CELULAR").alias("tipo_contato"),
        F.pmod(k, F.lit(2)).cast("int").alias("whatsapp"),
    )


# ---------------------------------------------------------------- reconciliation

def bank_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner statement lines (bank contracts): lineitem grouped by
    (order, line, part) joined to its order and part.

    ``src_id`` is a numeric key unique per line; keys are NULL on purpose
    (proposal when line % 3 = 0, contract when line % 4 = 0, client when
    order % 13 = 0) so rows fall through to later matching stages."""
    # dealt by order once, for the grouping and the join to orders; amounts are
    # decimals before that, as the sorted grouping would convert them slowly
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("_amount"), "l_shipdate", "l_returnflag")
    li = li.filter(F.col("l_orderkey").isNotNull()).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    g = (li.groupBy("l_orderkey", "l_linenumber", "l_partkey")
         .agg(F.sum("_amount").alias("_price"),
              F.min("l_shipdate").alias("_ship"),
              F.max("l_returnflag").alias("_flag")))
    j = g.join(o, g.l_orderkey == o.o_orderkey).join(p, g.l_partkey == p.p_partkey, "left")
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    bank = F.pmod(ok, F.lit(5))
    rate_txt = F.concat((F.lit(1) + F.pmod(pk, F.lit(3))).cast("string"), F.lit(","), F.pmod(pk, F.lit(10)).cast("string"))
    return j.select(
        ((ok * 8 + ln) * 1048576 + pk).alias("src_id"),
        _by_index(bank, BANK_NAMES).alias("nom_banco"),
        bank.alias("banco_id"),
        F.when(F.pmod(ln, F.lit(3)) != 0, ok.cast("string")).alias("num_proposta"),
        F.when(F.pmod(ln, F.lit(4)) != 0, F.concat(F.lit("CT"), ok.cast("string"))).alias("num_contrato"),
        F.when(F.pmod(ok, F.lit(13)) != 0, cpf_of(F.col("o_custkey"))).alias("cliente_id"),
        F.col("_price").alias("val_repasse"),
        F.when(ln == 1, F.col("o_totalprice").cast("decimal(18,2)")).otherwise(F.col("_price")).alias("val_liberado"),
        F.when(ln == 7, F.lit(None).cast("decimal(18,2)"))
         .when(F.col("_flag") == "R", F.lit(0).cast("decimal(18,2)"))
         .otherwise((F.col("_price") * F.lit(Decimal("0.05"))).cast("decimal(18,2)")).alias("val_comissao"),
        F.col("_ship").alias("dat_emprestimo"),
        F.date_add(F.to_date("_ship"), ln.cast("int")).cast("timestamp_ntz").alias("dat_credito"),
        F.when(F.col("_flag") == "R", F.lit("PENDENTE")).otherwise(F.lit("pago")).alias("status_producao"),
        F.concat(F.upper(F.col("p_brand")), F.lit(" - TAXA "), rate_txt, F.lit("% CÓD. "),
                 F.col("p_size").cast("string")).alias("dsc_produto"),
        F.concat(F.lit("CONVENIO "), F.upper(F.col("p_brand"))).alias("dsc_convenio"),
        ln.cast("int").alias("prazo"),
        F.col("_price").alias("val_bruto"),
        F.when(F.pmod(ln, F.lit(2)) == 0, F.lit("REFIN")).otherwise(F.lit("NOVO")).alias("tipo_operacao"),
        F.when(F.col("_flag") == "A", F.date_add(F.to_date("_ship"), 40).cast("timestamp_ntz")).alias("dat_confirmacao"),
        F.when(bank == 2, F.lit("BB")).otherwise(F.lit("NOVA")).alias("plataforma"),
    )


def rate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate versions (``tabela_taxas``) from ``part``: rule = brand, code =
    size; validity windows overlap on purpose; open versions have NULL end."""
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    start = F.date_add(F.lit("1994-01-01").cast("date"), (F.pmod(pk, F.lit(5)) * 365).cast("int"))
    return p.select(
        pk.alias("id"),
        F.upper(F.col("p_brand")).alias("descricao_banco"),
        F.col("p_size").cast("string").alias("codigo"),
        F.col("p_type").alias("forma_contrato"),
        (((F.lit(1) + F.pmod(pk, F.lit(3))) * 10 + F.pmod(pk, F.lit(10))).cast("double") / F.lit(10.0)).alias("taxa_total"),
        (((F.lit(1) + F.pmod(pk, F.lit(4))) * 10 + F.pmod(pk, F.lit(7))).cast("double") / F.lit(10.0)).alias("taxa_vista"),
        (F.pmod(pk, F.lit(50)).cast("double") / F.lit(10.0)).alias("comissao_vista"),
        start.alias("data_inicio"),
        F.when(F.pmod(pk, F.lit(3)) != 0, F.date_add(start, 700)).alias("data_fim"),
    )


# ---------------------------------------------------------------- rate versions

RATES_BANK = "banco_teste"


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned rate table (SCD-2): one version per part; closed versions
    (``p_partkey % 17 = 0``) carry an end date; ``prazo`` is zero padded."""
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return p.select(
        pk.alias("id"),
        F.concat(F.lit("R"), pk.cast("string"), F.lit("-"), F.col("p_size").cast("string")).alias("codigo"),
        F.upper(F.col("p_brand")).alias("descricao_banco"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("prazo"),
        (F.round(F.col("p_retailprice") * 100).cast("long").cast("double") / F.lit(100000.0)).alias("taxa_total"),
        (F.pmod(pk, F.lit(30)).cast("double") / F.lit(10.0)).alias("taxa_vista"),
        (F.pmod(pk, F.lit(9)).cast("double") / F.lit(10.0)).alias("comissao_total"),
        (F.pmod(pk, F.lit(9)).cast("double") / F.lit(10.0)).alias("comissao_vista"),
        F.lit(RATES_BANK).alias("banco"),
        F.lit("2024-01-01").cast("date").alias("data_inicio"),
        F.when(F.pmod(pk, F.lit(17)) == 0, F.lit("2024-06-30").cast("date")).alias("data_fim"),
    )


def new_rate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rate file: drops ``p_partkey % 10 = 0``, changes the rate of
    ``% 10 = 1`` and adds a new rule for ``% 10 = 2``."""
    p = read_table(spark, sf_dir, "part").filter(F.pmod(F.col("p_partkey"), F.lit(10)) != 0)
    pk = F.col("p_partkey")
    rate = F.round(F.col("p_retailprice") * 100).cast("long").cast("double") / F.lit(100000.0)
    base = p.select(
        F.concat(F.lit("R"), pk.cast("string")).alias("codigo_regra"),
        F.lit(None).cast("string").alias("range_faixa"),
        F.col("p_size").cast("string").alias("faixa_parcela"),
        F.upper(F.col("p_brand")).alias("descricao_regra"),
        F.when(F.pmod(pk, F.lit(10)) == 1, rate + F.lit(0.5)).otherwise(rate).alias("taxa_juros_sem_seguro"),
        (F.pmod(pk, F.lit(30)).cast("double") / F.lit(10.0)).alias("taxa_juros_com_seguro"),
        (F.pmod(pk, F.lit(9)).cast("double") / F.lit(10.0)).alias("percentual_comissao_a_vista"),
        pk.alias("_pk"),
    )
    added = base.filter(F.pmod(F.col("_pk"), F.lit(10)) == 2).withColumn(
        "codigo_regra", F.concat(F.lit("N"), F.col("_pk").cast("string")))
    return base.unionByName(added).drop("_pk")


# ---------------------------------------------------------------- funnel

def crm_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM WhatsApp messages (``crm_whatsapp``) from ``conversations``:
    assistant turns are outbound, system turns are notices."""
    c = read_table(spark, sf_dir, "conversations")
    base = F.to_timestamp_ntz(F.lit("2024-01-15 08:00:00"))
    return c.select(
        F.col("conv_id").alias("atendimento_id"),
        F.when(F.col("role") == "assistant", F.lit("out")).otherwise(F.lit("in")).alias("direcao"),
        F.when(F.col("role") == "system", F.lit("aviso")).otherwise(F.lit("texto")).alias("tipo"),
        (base + F.make_dt_interval(F.pmod(F.col("conv_id"), F.lit(20)).cast("int"), F.lit(0),
                                   F.col("turn").cast("int"))).alias("criado_em"),
    )


def crm_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM conversations (``crm_atendimentos``): one per conv_id; the contact
    is the customer with the same key."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return c.select(F.col("conv_id").alias("id"), F.col("conv_id").alias("contato_id"))


def crm_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact tags (``crm_contato_etiquetas``): every conversation's
    contact gets tags over its turns."""
    c = read_table(spark, sf_dir, "conversations")
    tag = (F.when(F.pmod(F.col("turn"), F.lit(4)) == 0, F.lit(30)).when(F.pmod(F.col("turn"), F.lit(4)) == 1, F.lit(20))
           .when(F.pmod(F.col("turn"), F.lit(4)) == 2, F.lit(15)).otherwise(F.lit(99)))
    return c.select(
        F.col("conv_id").alias("contato_id"),
        tag.cast("int").alias("etiqueta_id"),
        (F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))
         + F.make_dt_interval(F.lit(0), F.col("turn").cast("int"))).alias("data_etiqueta"),
    )


def campaign_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle-finance production (``producao_fin_banco``) with the client's
    phone; every third order is a campaign sale."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        phone_of(F.col("o_custkey")).alias("telefone_cliente"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit("CAMPANHA")).otherwise(F.lit("PARCEIRO")).alias("origem_venda"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("data_cancelamento"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor_comissao"),
        F.col("o_orderdate").alias("data_contrato"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor_veiculo"),
        F.concat(F.lit("R"), (F.pmod(k, F.lit(15)) + 5).cast("string")).alias("regra"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("N")).otherwise(F.lit("S")).alias("flag_estudo"),
    )


# ---------------------------------------------------------------- insurance

def insurance_instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insurance commission instalments (``comissao_seguro_auto``): one per
    line item; operation date as day-first text (padded or not)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    d = F.col("o_orderdate")
    txt = F.when(F.pmod(F.col("l_orderkey"), F.lit(2)) == 0, F.date_format(d, "dd/MM/yyyy")).otherwise(
        F.date_format(d, "d/M/yyyy"))
    return j.select(
        F.col("c_name").alias("segurado"),
        cpf_of(F.col("o_custkey")).alias("cpfcnpj_do_cliente"),
        txt.alias("data_da_operacao"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("/12")).alias("parcela"),
        F.when(F.col("l_returnflag").isin("R", "A"), F.lit("PENDENTE PAGAMENTO")).otherwise(F.lit("PAGO")).alias("status"),
    )


def insurance_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insurance sales (``producao_seguros``): one a customer, with a sale phone
    for even keys."""
    c, k = read_table(spark, sf_dir, "customer"), F.col("c_custkey")
    return c.select(cpf_of(k).alias("cliente_id"), F.when(F.pmod(k, F.lit(2)) == 0, phone_of(k)).alias("telefone_venda"))


def monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly index table (``pc_ila_financiamento``): one row per order month."""
    o = read_table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ano_mes")).distinct()
    return o.select("ano_mes", (F.pmod(F.substring("ano_mes", 6, 2).cast("int") * 7, F.lit(10)).cast("double")
                                / F.lit(2.0) + F.lit(1.5)).alias("pcila_txa"))


def consultants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales consultants: the suppliers (a staff table that grows with the data)."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("usuario_id"), F.col("s_name").alias("nome"))


# ---------------------------------------------------------------- effectiveness

def production_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production by line (``producao_extenso``): lineitem joined to its order;
    returned lines are credit-insurance products."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return j.select(
        cpf_of(F.col("o_custkey")).alias("cliente_id"),
        F.col("o_orderdate").alias("data_contrato"),
        F.when(F.col("l_returnflag") == "R", F.lit("SEGURO PRESTAMISTA")).otherwise(F.lit("CONSIGNADO")).alias("produto"),
        price.alias("Total_Liberado"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)").alias("valor_comissao"),
        price.alias("base_comissao"),
    )


def tabulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact tabulations: one per event, keyed by the user's CPF; purchases
    are effective tabulations.  Dated 26 years back so they share the
    production tables' era (1995-2001)."""
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return e.select(cpf_of(F.col("user_id")).alias("cpf"), (F.col("event_type") == "purchase").alias("efetiva"),
                    (F.col("ts") - F.expr("INTERVAL 26 YEARS")).alias("data"))


def client_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign client list: every customer, keyed by CPF."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(cpf_of(F.col("c_custkey")).alias("cliente_id"))


# ---------------------------------------------------------------- clients and campaigns

def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client registry (``clientes``): CPF digits, name, and one phone —
    mobile (with the ninth digit) for even keys, landline form (without it)
    for odd keys."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    k = F.col("c_custkey")
    mobile = S.digits(phone_of(k * 8))
    land = S.drop_ninth_digit(mobile)
    return c.select(
        k.alias("idTabela"), cpf_of(k).alias("id"), F.col("c_name").alias("nome"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit("M")).when(F.pmod(k, F.lit(3)) == 1, F.lit("F")).alias("genero"),
        F.when(F.pmod(k, F.lit(2)) == 1, land).alias("telefone"),
        F.when(F.pmod(k, F.lit(2)) == 0, mobile).alias("celular"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(k * 131, F.lit(20000)).cast("int")).alias("data_nasc"),
    )


def campaign_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign membership (``campanha_cliente``): every customer, each 13th in
    one of three campaigns, the others in none (NULL); no owner yet for some."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    camp = F.when(F.pmod(k, F.lit(13)) != 0, F.lit(None).cast("int")).otherwise( 
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(9011)).when(F.pmod(k, F.lit(3)) == 1, F.lit(15422)).otherwise(F.lit(777)))
    return c.select(camp.cast("long").alias("campanha_id"), k.alias("cliente_id"),
                    F.when(F.pmod(k, F.lit(39)) != 0, F.pmod(k, F.lit(7)) + 100).alias("usuario_id"))


def contact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemarketing contact log (``telemarketing``): one contact an order, each
    fiftieth in campaign 9011, the others outside any."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("relacao_id"),
                    F.when(F.pmod(F.col("o_orderkey"), F.lit(50)) == 0, F.lit(9011)).cast("long").alias("campanha_id"), F.col("o_orderdate").alias("dataregistro"))


def insurance_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insurance quote queue (``consulta_seguro``) from purchase events: a
    plate per contact (``CPF...`` placeholders for some), plate date and
    quote date set for part of them."""
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    eid, uid = F.col("event_id"), F.col("user_id")
    placa = F.when(F.pmod(eid, F.lit(9)) == 0, F.concat(F.lit("CPF"), uid.cast("string"))).otherwise(
        F.concat(F.lit("ABC"), F.lpad(F.pmod(eid, F.lit(10000)).cast("string"), 4, "0")))
    usos = F.element_at(F.array(*[F.lit(u) for u in ("PARTICULAR", "APLICATIVO", "PCD", "TAXISTA", "FROTA")]),
                        (F.pmod(eid, F.lit(5)) + 1).cast("int"))
    return e.select(
        eid.alias("contato_id"), placa.alias("placa"), cpf_of(uid).alias("cpf"),
        F.element_at(F.array(*[F.lit(u) for u in ("sp", "RJ", "mg", "XX")]), (F.pmod(uid, F.lit(4)) + 1).cast("int")).alias("uf_licenciamento"),
        F.when(F.pmod(eid, F.lit(2)) == 0, F.lit("Usado")).otherwise(F.lit("0km/Novo")).alias("estado_veiculo"),
        F.concat(F.lit("MARCA "), F.pmod(uid, F.lit(12)).cast("string")).alias("marca"),
        F.when(F.pmod(eid, F.lit(11)) != 0, F.concat(F.lit("MODELO "), F.pmod(uid, F.lit(40)).cast("string"),
                                                     F.lit(" 1.6 FLEX"))).alias("modelo"),
        F.when(F.pmod(uid, F.lit(5)) == 0, F.lit("MOTO")).otherwise(F.lit("CARRO")).alias("tipo_veiculo"),
        F.concat((F.lit(2010) + F.pmod(eid, F.lit(16))).cast("string"), F.lit(" FLEX")).alias("ano_combustivel"),
        F.when(F.pmod(eid, F.lit(7)) != 0, F.col("value") * 300).alias("preco_medio_veiculo"),
        usos.alias("uso_veiculo"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(uid * 97, F.lit(15000)).cast("int")).alias("data_nascimento"),
        F.when(F.pmod(eid, F.lit(4)) != 0, F.col("ts")).alias("data_placa"),
        F.when(F.pmod(eid, F.lit(5)) == 0, F.col("ts")).alias("data_consulta"),
    )


# State codes in alphabetical order (address fixture).
STATE_CODES = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
               "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO"]


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client addresses (``logradouro``): every customer has one,
    every eighth (key % 8 = 1) a second, newer one in another state."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    states = F.array(*[F.lit(s) for s in STATE_CODES])
    first = c.select(
        (k * 10 + 1).alias("id"), k.alias("cliente_id"), F.element_at(states, (F.pmod(n, F.lit(27)) + 1).cast("int")).alias("uf"))
    second = c.filter(F.pmod(k, F.lit(8)) == 1).select(
        (k * 10 + 2).alias("id"), k.alias("cliente_id"), F.element_at(states, (F.pmod(n + 5, F.lit(27)) + 1).cast("int")).alias("uf"))
    return first.unionByName(second)


def client_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client-to-contact links (``cliente_contato``): each customer to its contact."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(F.col("c_custkey").alias("cliente_id"), F.col("c_custkey").alias("contato_id"))


def telemarketing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact-log entries with free text (``telemarketing``): one an
    order; a phone is embedded as ``>(dd)9nnnnnnnn<`` in most texts."""
    o = read_table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    dd = (F.lit(11) + F.pmod(c, F.lit(89))).cast("string")
    num = F.concat(F.lit("9"), F.lpad(F.pmod(c * F.lit(7919), F.lit(100000000)).cast("string"), 8, "0"))
    texto = (F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("string"))
             .when(F.pmod(k, F.lit(5)) == 1, F.lit("sem telefone"))
             .otherwise(F.concat(F.lit("Contato <b>>("), dd, F.lit(")"), num, F.lit("<</b> ok"))))
    return o.select(
        k.alias("id"), F.when(F.pmod(k, F.lit(3)) == 0, F.lit("empresa")).otherwise(F.lit("cliente")).alias("relacao"),
        c.alias("relacao_id"), F.when(F.pmod(k, F.lit(11)) != 0, F.pmod(k, F.lit(11))).alias("usuario_id"),
        F.pmod(k, F.lit(4)).alias("status_telemarketing_id"), texto.alias("texto"), F.col("o_orderdate").alias("dataregistro"))


def staff_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform users (``usuario``): logins from the supplier table."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("user"), F.col("s_suppkey").cast("string")).alias("login"))
