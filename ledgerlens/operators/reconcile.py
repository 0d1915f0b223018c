"""Commission reconciliation: staged one-to-one pairing of partner statements
against internal production, effective-dated rate lookup, commission
recalculation and the report set (P23, S13, J16-J20, W6, W11, U3, C13-C16).

Scale design
------------
* Only narrow key tables (id + the five key columns) take part in the
  pairing loop.  They stand once in the shared checkpoint folder, and every
  stage writes one table, of its pairs and of the rows that it left pending,
  so stage ``k`` never recomputes the earlier stages (a lost executor only
  re-reads checkpoint files).
* Each stage hands on only the rows that it left pending, with the keys that
  later stages use; rows without the stage's key pass it by unshuffled.
* Inside a stage both sides go through one shuffle, by key: ranked by id
  within key and side, rows of one key and rank are a pair.  That yields
  min(m, n) pairs per key in id order, at any key size: hot keys are cut into
  id ranges (``ranked_within``).
* An id that comes twice is paired once: rows of such ids are marked, and only
  they go through an anti-join on the paired ids.
* NULL keys never match (trap T3 default); ``match_missing=True`` restores
  the sentinel behaviour where missing matches missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.functions.dates import ts_ntz
from ledgerlens.functions.similarity import with_distinct_ratio
from ledgerlens.operators import merge as MG
from ledgerlens.operators.skew import DEFAULT_BROADCAST_MAX, DEFAULT_HOT_THRESHOLD, crowded_keys, hot_keys, latest_per_key, ranked_within
from ledgerlens.operators.versions import lookup, version_tree
from ledgerlens.session import cut_lineage

# The five matching stages, in order (name, keys).
STAGES = [
    ("Etapa 1: CPF + Número Proposta", ["cliente_id", "numero_proposta"]),
    ("Etapa 2: CPF + Número Contrato", ["cliente_id", "numero_contrato"]),
    ("Etapa 3: Banco + Número Proposta", ["banco_id", "numero_proposta"]),
    ("Etapa 4: Banco + Número Contrato", ["banco_id", "numero_contrato"]),
    ("Etapa 5: CPF + Valor Liberado", ["cliente_id", "valor_liberado"]),
]
SINGLE_STAGE = [("Etapa 1: Número Proposta", ["numero_proposta"])]
MISSING = "<NA>"
# Rows that one task of a matching stage ranks, about.
TASK_ROWS = 500_000
# Banks left out of the final report.
REPORT_EXCLUDED_BANKS = ["BANCO DO BRASIL", "SABEMI"]


def prepare_statements(df: DataFrame) -> DataFrame:
    """Statement preparation: renames, tolerant dates, cleaned keys,
    masked CPF, nullable bank id, ``valor_liberado`` as 2-place decimal.
    Text that is no date or number becomes missing, as in the source."""
    return df.select(
        "*",
        F.col("dat_emprestimo").try_cast("timestamp_ntz").alias("data_emprestimo"),
        F.col("dat_credito").try_cast("timestamp_ntz").alias("data_contrato"),
        S.clean_key(F.col("num_proposta")).alias("numero_proposta"),
        S.clean_key(F.col("num_contrato")).alias("numero_contrato"),
        S.cpf_mask(F.col("cliente_id")).alias("cpf_fmt"),
        F.col("val_liberado").try_cast("decimal(18,2)").alias("valor_liberado"),
    ).drop("cliente_id").withColumnRenamed("cpf_fmt", "cliente_id").withColumn(
        "banco_id", F.col("banco_id").try_cast("long"))


def prepare_production(df: DataFrame) -> DataFrame:
    """Production side: cleaned keys, masked CPF, ``valor_liberado``
    defaulting to ``base_comissao`` when absent."""
    if "valor_liberado" not in df.columns:
        df = df.withColumn("valor_liberado", F.col("base_comissao"))
    return (df.withColumn("numero_proposta", S.clean_key(F.col("numero_proposta")))
            .withColumn("numero_contrato", S.clean_key(F.col("numero_contrato")))
            .withColumn("banco_id", F.col("banco_id").try_cast("long"))
            .withColumn("cliente_id", S.cpf_mask(F.col("cliente_id")))
            .withColumn("valor_liberado", F.col("valor_liberado").try_cast("decimal(18,2)")))


def production_in_span(production: DataFrame, statements: DataFrame,
                       date_col: str = "data_contrato", span_col: str = "dat_emprestimo") -> DataFrame:
    """Production rows within the statements' date span (two scalar
    subqueries, evaluated once; the filter runs inside the production scan
    stage)."""
    lo = statements.agg(F.min(span_col)).scalar()
    hi = statements.agg(F.max(span_col)).scalar()
    return production.filter(F.col(date_col).between(lo, hi))


def _key_table(df: DataFrame, id_col: str, key_cols: list[str], match_missing: bool) -> DataFrame:
    cols = [F.col(id_col)]
    for c in key_cols:
        col = F.col(c)
        if match_missing:
            col = F.coalesce(col.cast("string"), F.lit(MISSING))
        cols.append(col.alias(c))
    return df.select(*cols)


def _met(ranked: DataFrame, keys: list[str], right_id: str) -> DataFrame:
    """``_hit``: the other side has a row of the same key and rank; a left
    row gets its id."""
    met = Window.partitionBy("_h", *keys, "rn")
    return (ranked.withColumn("_hit", F.count(F.lit(1)).over(met) > 1)
            .withColumn("_other", F.max(right_id).over(met)).drop("rn", "_h"))


def _marked(pending: DataFrame, again: DataFrame, left_id: str, right_id: str, n_again: int) -> DataFrame:
    """``pending`` with ``_again``: the row's id is one of ``again``."""
    few = F.broadcast if n_again <= DEFAULT_BROADCAST_MAX else (lambda df: df)
    out = []
    for c, side in ((left_id, F.col("_left")), (right_id, ~F.col("_left"))):
        ids = again.filter(F.col(c).isNotNull()).select(F.col(c).alias("_id"), F.lit(True).alias("_again"))
        rows = pending.filter(side).join(few(ids), F.col(c) == F.col("_id"), "left")
        out.append(rows.withColumn("_again", F.coalesce("_again", F.lit(False))).drop("_id"))
    return out[0].unionByName(out[1])


def _paired(rows: DataFrame, keys: list[str], left_id: str, right_id: str, hot_threshold: int,
            salt_buckets: int | None, crowded: bool, tasks: int) -> DataFrame:
    """Both sides' rows of one stage with ``_hit`` and ``_other``: dealt once
    by key, ranked by id within key and side, and met by rank in the same
    tasks.  Hot keys' rows are ranked apart, in id ranges, and meet by (key,
    rank); they are looked for if ``crowded``."""
    hot, n_hot = hot_keys(rows, keys, hot_threshold) if crowded else (None, 0)
    cold = rows
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= DEFAULT_BROADCAST_MAX else hot
        cold = rows.join(hot, keys, "left_anti")
    h = F.xxhash64(*keys)  # after the shuffle: rows are sorted by a number first, then by the keys
    side = Window.partitionBy("_h", *keys, "_left").orderBy(left_id, right_id)
    out = _met(cold.repartition(tasks, *keys).withColumn("_h", h).withColumn("rn", F.row_number().over(side).cast("long")), keys, right_id)
    if n_hot:
        apart = rows.join(hot, keys, "left_semi").withColumn("_id", F.coalesce(left_id, right_id))
        ranked = ranked_within(apart, [*keys, "_left"], "_id", hot_threshold=hot_threshold, buckets=salt_buckets).drop("_id").withColumn("_h", h)
        out = out.unionByName(_met(ranked, keys, right_id))
    return out


def staged_pairing(left: DataFrame, right: DataFrame, stages=STAGES, left_id: str = "src_id",
                   right_id: str = "id", match_missing: bool = False, checkpoint: bool = True,
                   hot_threshold: int = DEFAULT_HOT_THRESHOLD, salt_buckets: int | None = None,
                   left_held: bool = False) -> DataFrame:
    """J18/J19 + W11: one-to-one pairs over ordered key stages.

    Returns ``(left_id, right_id, etapa, etapa_nome)``; each id appears at
    most once, and stage ``k`` only sees rows unpaired by stages ``< k``.
    ``left_held``: ``left`` is a table on disk already, not to be copied."""
    key_cols = sorted({c for _, ks in stages for c in ks})
    lk = _key_table(left, left_id, key_cols, match_missing)
    rk = _key_table(right, right_id, key_cols, match_missing)
    cut = cut_lineage if checkpoint else (lambda df, name: df)
    lk, rk = lk if left_held else cut(lk, "pair-left-keys"), cut(rk, "pair-right-keys")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    pending = lk.select(F.lit(True).alias("_left"), left_id, none(rk, right_id), *key_cols).unionByName(
        rk.select(F.lit(False).alias("_left"), none(lk, left_id), right_id, *key_cols))
    own = F.when(F.col("_left"), F.col(left_id).isNotNull()).otherwise(F.col(right_id).isNotNull())
    again = cut(pending.filter(own).groupBy(left_id, right_id).agg(F.count(F.lit(1)).alias("_n"))
                .filter("_n > 1").select(left_id, right_id), "repeated-ids")
    n_again = again.count()
    mark = ["_again"] if n_again else []
    if n_again:  # rows whose id comes again are told apart once
        pending = _marked(pending, again, left_id, right_id, n_again)
        if n_again > DEFAULT_BROADCAST_MAX:
            pending = cut(pending, "pending0")
    # a task sorts its rows twice: their number bounds its memory
    tasks = max(int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pending.count() // TASK_ROWS))
    crowded = crowded_keys(pending, [ks for _, ks in stages], hot_threshold)
    done = None
    for i, (name, keys) in enumerate(stages, start=1):
        later = [c for c in key_cols if any(c in ks for _, ks in stages[i:])]
        met = _paired(pending.dropna(subset=keys), keys, left_id, right_id, hot_threshold, salt_buckets, i - 1 in crowded, tasks)
        found = F.col("_left") & F.col("_hit")
        stays = ~F.col("_hit") | ~own  # a row without an id is never left out later
        kept = reduce(Column.__or__, [found, *([stays] if later else []), *[F.col(c) for c in mark if later]])
        stage = met.filter(kept).select(
            "_left", "_hit", left_id, right_id, "_other", stays.alias("_stays"), *mark, *[F.when(stays, F.col(c)).alias(c) for c in later])
        stage = cut(stage, f"pairs-stage{i}")
        pairs = stage.filter(found).select(left_id, F.col("_other").alias(right_id), F.lit(i).alias("etapa"), F.lit(name).alias("etapa_nome"))
        done = pairs if done is None else done.unionByName(pairs)
        if later:  # only the rows still pending go on
            carried = ["_left", left_id, right_id, *mark, *later]
            lacking = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
            pending = stage.filter("_stays").select(*carried).unionByName(pending.filter(lacking).select(*carried))
            if mark:  # other rows of a paired id leave with it
                rest, gone = pending.filter("_again"), stage.filter("_hit AND _again")
                for c, side in ((left_id, F.col("_left")), (right_id, ~F.col("_left"))):
                    rest = rest.join(gone.filter(side).select(c).distinct(), c, "left_anti")
                pending = pending.filter("NOT _again").unionByName(cut(rest.select(*carried), f"pending{i}"))
    return done


def stage_summary(pairs: DataFrame) -> DataFrame:
    """RESUMO: pairs per stage."""
    return pairs.groupBy("etapa", "etapa_nome").agg(F.count(F.lit(1)).cast("long").alias("registros"))


# ------------------------------------------------------------------ rates

def effective_rate(statements: DataFrame, rates: DataFrame, open_end: str = "2099-12-31") -> DataFrame:
    """Effective-dated rate per statement line.

    Rule and code are parsed from the product text; the loan date lies inside
    ``[data_inicio, coalesce(data_fim, open_end)]``; best version by rate match
    first and highest percentage next (id as final tie-break).  Two lookups in
    version trees (see ``versions``): among the versions that carry the line's
    own rate, and, for lines without one, among all.  ``src_id`` names a line.
    """
    text = F.col("_produto")  # in capitals once, for all three patterns
    st = statements.select("src_id", "data_emprestimo", F.upper("dsc_produto").alias("_produto")).select(
        "src_id", "data_emprestimo",
        S.upper_trim(S.product_rule(text, upper=False)).alias("regra_extraida"),
        S.product_rate(text, upper=False).alias("taxa_extraida"),
        S.upper_trim(S.product_code(text, upper=False)).alias("codigo_extraido"))
    rt = rates.select(
        S.upper_trim(F.col("descricao_banco")).alias("regra"),
        S.upper_trim(F.col("codigo")).alias("inicio_regra"),
        S.numeric_text(F.col("taxa_total")).alias("taxa_com_seguro"),
        S.numeric_text(F.col("taxa_vista")).alias("taxa_sem_seguro"),
        S.numeric_text(F.col("comissao_vista")).alias("perc_empresa_avista"),
        F.col("data_inicio"),
        F.coalesce(F.col("data_fim"), F.lit(open_end).cast("date")).alias("data_fim"),
        F.col("id").alias("taxa_id"))
    # one tree: a version stands under each of its rates, and under any rate
    anyway, order = F.lit("*"), ["perc_empresa_avista", "taxa_id"]
    own = F.transform(F.array(F.round("taxa_com_seguro", 2), F.round("taxa_sem_seguro", 2)), lambda x: x.cast("string"))
    rated = rt.withColumn("_taxa", F.explode(F.array_distinct(F.concat(own, F.array(anyway)))))
    versions = version_tree(rated, ["regra", "inicio_regra", "_taxa"], F.col("data_inicio"), F.col("data_fim"), order, order)
    lines = st.select("src_id", "data_emprestimo", F.col("regra_extraida").alias("regra"), F.col("codigo_extraido").alias("inicio_regra"),
                      F.round("taxa_extraida", 2).cast("string").alias("_taxa"))
    exact = lookup(lines, versions, F.col("data_emprestimo")).withColumnsRenamed({"taxa_id": "_id", "perc_empresa_avista": "_perc"})
    match = F.col("_id").isNotNull()
    best = lookup(exact.withColumn("_taxa", F.when(~match, anyway)), versions, F.col("data_emprestimo"))
    return best.filter(match | F.col("taxa_id").isNotNull()).select(
        "src_id", F.when(match, F.col("_id")).otherwise(F.col("taxa_id")).alias("taxa_id"), match.alias("match_taxa"),
        F.when(match, F.col("_perc")).otherwise(F.col("perc_empresa_avista")).alias("perc_empresa_avista"))


def expected_commission(statements: DataFrame, best_rates: DataFrame) -> DataFrame:
    """SANTANDER lines with amount, commission and percentage present get
    ``round(val_liberado * perc / 100, 2)``; all others keep the reported value."""
    j = statements.join(best_rates, "src_id", "left")
    cond = (F.upper(F.coalesce(F.col("nom_banco"), F.lit(""))).contains("SANTANDER")
            & F.col("val_repasse").isNotNull() & F.col("val_comissao").isNotNull()
            & F.col("perc_empresa_avista").isNotNull())
    recalc = F.round(F.col("val_liberado").cast("double") * (F.col("perc_empresa_avista") / F.lit(100.0)), 2)
    return j.withColumn("val_comissao_total",
                        F.when(cond, recalc).otherwise(F.col("val_comissao").cast("double")))


# What rates, commissions and the write-back read of a statement.
WRITE_BACK_COLUMNS = ["src_id", "data_emprestimo", "nom_banco", "dsc_produto", "val_repasse", "val_comissao", "val_liberado", "val_bruto", "prazo"]


def paired_statements(statements: DataFrame, pairs: DataFrame) -> DataFrame:
    """The statement lines that a write-back needs: those with a pair, once
    on disk, so that rates and commissions of the others are not worked out.
    The keys of the pairing stay behind."""
    statements = statements.select(*[c for c in WRITE_BACK_COLUMNS if c in statements.columns])
    return cut_lineage(statements.join(pairs.select("src_id"), "src_id", "left_semi"), "paired-statements")


def production_write_back(production: DataFrame, pairs: DataFrame, recalculated: DataFrame, since: str) -> DataFrame:
    """C16 + K8: matched contracts on or after ``since`` get the statement's
    base, commission, term and table; its amounts only where they are there
    and not zero."""
    amount = lambda c: F.when(F.col(c) != 0, F.col(c))
    lines = recalculated.select("src_id", F.col("val_repasse").alias("base_comissao"), F.col("val_comissao_total").alias("valor_comissao"),
                                amount("val_repasse").alias("valor_liberado"), amount("val_bruto").alias("valor_financiado"), "prazo",
                                F.col("dsc_produto").alias("tabela"))
    updates = pairs.select("src_id", "id").join(lines, "src_id").drop("src_id")
    return MG.merge(production, updates, ["id"], {
        "base_comissao": MG.OVERWRITE, "valor_comissao": MG.OVERWRITE, "valor_liberado": MG.KEEP_OLD_IF_NEW_NULL,
        "valor_financiado": MG.KEEP_OLD_IF_NEW_NULL, "prazo": MG.OVERWRITE, "tabela": MG.OVERWRITE},
        guard=F.col("data_contrato") >= F.lit(since).cast("timestamp_ntz"))


# ------------------------------------------------------------------ reports

def unmatched(df: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """Rows without a pair (left anti-join on the id)."""
    return df.join(pairs.select(id_col), id_col, "left_anti")


def commission_flags(statements: DataFrame, as_of, start_date: str, days: int = 30) -> DataFrame:
    """COMISSAO_NULA / COMISSAO_ZERO filter window: credited within ``days``
    of ``as_of`` and on/after ``start_date``, or with no credit date."""
    dc = F.to_date(F.col("data_contrato"))
    window = (((dc >= F.date_sub(F.to_date(ts_ntz(as_of)), days)) & (dc >= F.lit(start_date).cast("date")))
              | F.col("data_contrato").isNull())
    return statements.withColumn("_in_window", window)


# The report's blocks, by priority.
REPORT_BLOCKS = ["PAGAMENTOS", "NAO_ENCONTRADOS_ECB", "COMISSAO_NULA", "COMISSAO_ZERO", "PAGO"]
REPORT_COLUMNS = {"nom_banco": "string", "num_proposta": "string", "num_contrato": "string", "val_comissao": "decimal(18,2)",
                  "status_producao": "string", "tipo_operacao": "string", "val_liberado": "decimal(18,2)",
                  "dat_credito": "timestamp_ntz", "data_esperada_pgto": "date", "status_pgto": "string"}
# what the report reads of a statement beside its keys
REPORT_STATEMENT_COLUMNS = ["nom_banco", "num_proposta", "num_contrato", "val_comissao", "status_producao", "tipo_operacao",
                            "val_liberado", "dat_credito", "data_contrato"]


def _block(df: DataFrame, name: str, id_col: str) -> DataFrame:
    """Rows in the report's columns; those a source lacks are NULL."""
    cols = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in REPORT_COLUMNS.items()]
    return df.select(*cols, F.lit(name).alias("tabela"), F.col(id_col).alias("_rid"),
                     F.lit(REPORT_BLOCKS.index(name) + 1).alias("prioridade"))


def commission_blocks(statements: DataFrame, as_of, start_date: str) -> dict[str, DataFrame]:
    """COMISSAO_NULA and COMISSAO_ZERO: lines without a commission, or with
    none, inside the filter window."""
    flagged = commission_flags(statements, as_of, start_date).filter("_in_window").drop("_in_window")
    amount = F.col("val_comissao").try_cast("decimal(18,2)")
    return {"COMISSAO_NULA": flagged.filter(F.col("val_comissao").isNull()), "COMISSAO_ZERO": flagged.filter(amount == 0)}


def report(statements: DataFrame, production: DataFrame, pairs: DataFrame, payments: DataFrame, as_of,
           start_date: str, days_back: int = 63) -> DataFrame:
    """C14 'REPORT': prioritised union of payments due (1: contracts with
    their expected date and status), unmatched production (2), null
    commission (3), zero commission (4) and paid lines (5), credited within
    ``days_back`` days; one row per proposal (NULL proposals form one group,
    as in the reference), highest priority first; two banks excluded (NULL
    bank kept, trap T21).  The per-proposal pick is a partial aggregate."""
    flagged = commission_blocks(statements, as_of, start_date)
    unpaired = unmatched(production, pairs, "id").select(
        "id", F.col("numero_proposta").alias("num_proposta"), F.col("numero_contrato").alias("num_contrato"),
        F.col("valor_comissao").alias("val_comissao"), F.col("valor_liberado").alias("val_liberado"),
        F.col("data_contrato").alias("dat_credito"))
    paid = statements.filter(F.col("val_comissao").isNotNull() & (F.col("status_producao") == "pago"))
    parts = [_block(payments, "PAGAMENTOS", "src_id"), _block(unpaired, "NAO_ENCONTRADOS_ECB", "id"),
             *[_block(df, name, "src_id") for name, df in flagged.items()], _block(paid, "PAGO", "src_id")]
    since = ts_ntz(as_of) - F.expr(f"INTERVAL {days_back} DAYS")
    stacked = reduce(DataFrame.unionByName, parts).filter(F.col("dat_credito").isNotNull() & (F.col("dat_credito") >= since))
    # keep the first row per proposal by (priority asc, id asc): max over negated order
    stacked = stacked.withColumn("_neg_p", -F.col("prioridade")).withColumn("_neg_id", -F.col("_rid"))
    payload = [c for c in [*REPORT_COLUMNS, "tabela"] if c != "num_proposta"]
    best = latest_per_key(stacked, ["num_proposta"], ["_neg_p", "_neg_id"], payload)
    return best.filter(~F.coalesce(F.col("nom_banco").isin(*REPORT_EXCLUDED_BANKS), F.lit(False)))


def agreement_similarity(statements: DataFrame, production: DataFrame, pairs: DataFrame) -> DataFrame:
    """C14 'CONVENIOS' + J20 + J29: matched pairs with the similarity of the
    statement's agreement text and the production's agreement name.  Each
    distinct pair of texts is scored once."""
    j = (pairs.join(statements.select("src_id", "dsc_convenio"), "src_id")
         .join(production.select("id", "convenio"), "id"))
    return with_distinct_ratio(j, "dsc_convenio", "convenio", "semelhanca")


def effective_dated_lookup(rows: DataFrame, versions: DataFrame, keys: list[str], date_col: str,
                           start_col: str, end_col: str, value_cols: list[str], row_id: str,
                           order_cols: list[str] | None = None, open_end: str = "2099-12-31") -> DataFrame:
    """J17 (and the general form of J16): for each row, the version whose
    keys match and whose ``[start, coalesce(end, open_end)]`` contains the
    row's date; among several, the greatest by ``order_cols`` (default:
    newest start).  ``row_id`` is not needed for the lookup: every row comes
    out once, with ``value_cols`` (see ``versions``)."""
    order_cols = order_cols or [start_col]
    end = F.coalesce(F.col(end_col), F.lit(open_end).cast("date"))
    return lookup(rows, version_tree(versions, keys, F.col(start_col), end, order_cols, value_cols), F.col(date_col))


def stack_platform_views(nova: DataFrame, bb: DataFrame) -> DataFrame:
    """U2 + U3 + A9: the two partner contract views as one table — paid NOVA
    contracts and BB contracts in production, each tagged with its platform,
    BB padded with NULLs for the columns it lacks and a fixed bank id —
    then whole-row de-duplicated."""
    n = (nova.filter(F.upper(F.col("status_producao")).contains("PAGO"))
         .select("nom_banco", "num_proposta", "num_contrato", "cliente_id", "val_repasse", "val_comissao",
                 "dat_emprestimo", "status_producao", "banco_id", F.lit("NOVA").alias("plataforma"), "tipo_operacao",
                 F.col("val_repasse").alias("val_liberado"), "dat_credito", "dsc_produto", "prazo", "dsc_convenio",
                 "val_bruto"))
    b = (bb.filter(F.upper(F.col("status_producao")) == "PRODUÇÃO")
         .select("nom_banco", "num_proposta", "num_contrato", "cliente_id", "val_repasse", "val_comissao",
                 "dat_emprestimo", "status_producao", F.lit(3).cast("long").alias("banco_id"),
                 F.lit("BB").alias("plataforma"), "val_liberado", "dat_credito", "prazo", "val_bruto"))
    both = n.unionByName(b, allowMissingColumns=True)
    # dealt by whole rows before they are compared: one table of rows a task, in all shuffle partitions
    return both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), *both.columns).distinct()
