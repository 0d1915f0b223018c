"""Partner file feeds: registry, per-feed hooks and JSON statement
flattening (S2-S7, S14, P10-P12, P15, X1).

Each feed names the file-name parts and extensions to pick up, the target
table and an optional hook (``DataFrame -> DataFrame``) applied through
``DataFrame.transform``.  Files may differ in columns: their header lines are
read in one job, and files with one header are one read, so a thousand files
of three layouts make three reads; the reads are united by column name and go
through the idempotent insert (K1) into an append-only table.  Statements are
told apart by their columns, not their names (P11).  Spreadsheets are re-aimed:
sheets arrive as CSV/Parquet files and the sheet name is part of the file
name (xlsx decoding is not built).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.sources import append_table as AT
from ledgerlens.sources import ingest as IG

# The columns a FGTS commission file must have.
FGTS_COLUMNS = ["corban", "cliente", "produto", "produto detalhado", "operação", "vop", "juros da op", "iof",
                "líquido", "custo de emissão", "r$ comissão"]
# Columns that mark a finance (not commission) statement.
FINANCE_COLUMNS = {"tipo_de_veiculo", "condicao", "valor_liberado", "status"}
# Consortium report column map (normalised name -> target).
ANCORA_COLUMNS = {
    "no_doc": "n_doc", "repres": "repres", "data": "data", "descricao": "descricao", "tipo": "tipo",
    "contrato": "contrato", "venda": "venda", "grupo": "grupo", "cota": "cota", "parcela": "parcela",
    "valor_base_carta_de_credito": "valor_base", "valor": "valor",
}


def preprocess_fgts(df: DataFrame) -> DataFrame:
    """P10: lower/strip the names; a file missing a required column yields
    an empty frame."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    return IG.require_columns(df, FGTS_COLUMNS)


def statement_kind(df: DataFrame) -> tuple[str, DataFrame]:
    """Normalised names, ``data_do_extrato`` dropped; ``financeiro`` when
    the finance columns are all present, else ``comissao``."""
    df = df.toDF(*[IG.normalize_name(c) for c in df.columns])
    if "data_do_extrato" in df.columns:
        df = df.drop("data_do_extrato")
    return ("financeiro" if FINANCE_COLUMNS <= set(df.columns) else "comissao"), df


def statement_columns(df: DataFrame) -> DataFrame:
    return statement_kind(df)[1]


def preprocess_ancora(df: DataFrame, user_id: int = 0) -> DataFrame:
    """P12 + P15: names normalised, renamed and selected in order, day-first
    dates parsed, a constant inserting-user column added."""
    names = ["".join(ch for ch in IG.normalize_name_v2(c) if ch.isalnum() or ch == "_") for c in df.columns]
    df = df.toDF(*names)
    df = df.select(*[F.col(src).alias(dst) for src, dst in ANCORA_COLUMNS.items()])
    return (df.withColumn("data", D.parse_day_first(F.col("data")))
            .withColumn("venda", D.parse_day_first(F.col("venda")))
            .withColumn("usuario_insercao", F.lit(user_id)))


FINANCE_STATEMENT_SCHEMA = (
    "extratoComissaoDetalheContrato struct<"
    "contrato: struct<idContrato: string, vlLiquido: double, dtEmissao: string, dtLiberacao: string, dtPagamento: string>,"
    "dadosCliente: struct<nrCpfCnpj: string, nrChassi: string>,"
    "acordo: struct<nrAcordo: string, dsTipoComissao: string, vlBruto: double, vlIR: double, vlISS: double,"
    " pcIla: double, vlIla: double>>,"
    "resumoExtratoComissaoContratoDetalhe struct<dtInicial: string, dtFinal: string, vlLiquidoTotal: double>")


def flatten_finance_statement(df: DataFrame) -> DataFrame:
    """One row per JSON statement; amounts default to 0, the chassis is
    trimmed text (missing -> '')."""
    d = "extratoComissaoDetalheContrato"
    r = "resumoExtratoComissaoContratoDetalhe"
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.select(
        F.col(f"{d}.contrato.idContrato").alias("idContrato"),
        F.col(f"{d}.dadosCliente.nrCpfCnpj").alias("nrCpfCnpj"),
        F.trim(F.coalesce(F.col(f"{d}.dadosCliente.nrChassi"), F.lit(""))).alias("nrChassi"),
        z(f"{d}.contrato.vlLiquido").alias("vlLiquido"),
        F.col(f"{d}.contrato.dtEmissao").alias("dtEmissao"),
        F.col(f"{d}.contrato.dtLiberacao").alias("dtLiberacao"),
        F.col(f"{d}.contrato.dtPagamento").alias("dtPagamento"),
        F.col(f"{d}.acordo.nrAcordo").alias("nrAcordo"),
        F.col(f"{d}.acordo.dsTipoComissao").alias("tipoComissao"),
        z(f"{d}.acordo.vlBruto").alias("vlBruto"), z(f"{d}.acordo.vlIR").alias("vlIR"),
        z(f"{d}.acordo.vlISS").alias("vlISS"), z(f"{d}.acordo.pcIla").alias("pcIla"),
        z(f"{d}.acordo.vlIla").alias("vlIla"),
        F.col(f"{r}.dtInicial").alias("dtInicial"), F.col(f"{r}.dtFinal").alias("dtFinal"),
        z(f"{r}.vlLiquidoTotal").alias("vlLiquidoTotal"))


@dataclass
class Feed:
    name_parts: list[str]
    extensions: tuple[str, ...]
    target: str
    fmt: str = "csv"
    sep: str = ";"
    hook: Callable[[DataFrame], DataFrame] | None = None
    recursive: bool = False
    schema: str | None = None
    without: tuple[str, ...] = ()   # name parts of other feeds' files
    required: frozenset = frozenset()  # columns a file must have, or it is refused
    kind: str | None = None         # of statements: only files of this kind (P11)
    years: tuple[int, ...] = ()     # the first folder below the root is one of these
    folder_part: str | None = None  # a folder below that has this in its name


# The feed registry (file name parts -> target table).
FEEDS = [
    Feed(["producaomensalbd"], (".csv",), "contratos_bb"),
    Feed(["_todos_", "a vista"], (".csv",), "comissao_bb"),
    Feed(["contratos_digitados_de_"], (".csv",), "contratos_nova"),
    Feed(["uy3"], (".csv",), "comissao_uy3", hook=preprocess_fgts, recursive=True, without=("uy3-prod",),
         required=frozenset(FGTS_COLUMNS), years=(2025,), folder_part="fgts"),
    Feed(["uy3-prod"], (".csv",), "contratos_uy3"),
    Feed(["extrato_"], (".csv",), "extrato_comissao_plataforma", hook=statement_columns, kind="comissao"),
    Feed(["extrato_"], (".csv",), "extrato_financeiro_plataforma", hook=statement_columns, kind="financeiro"),
    Feed(["extrato_comissao_finveiculo_vivero"], (".json",), "extrato_financeiro_vivero", fmt="json",
         hook=flatten_finance_statement, schema=FINANCE_STATEMENT_SCHEMA),
    Feed(["comissãoplanilhamãe"], (".csv",), "relatorio_comissao_ancora", hook=preprocess_ancora),
    Feed(["extrato de comissao de seguro auto"], (".csv",), "comissao_seguro_auto"),
]


def feed_files(spark: SparkSession, folder: str, feed: Feed) -> list[str]:
    """S2 + S5: the feed's files by name, and by year and folder where the
    feed says so."""
    base = IG._hadoop_path(spark, folder)[0].toUri().getPath().rstrip("/")
    out = []
    for path in IG.find_files(spark, folder, feed.extensions, feed.name_parts, recursive=feed.recursive):
        *folders, name = path.split(base, 1)[1].strip("/").lower().split("/")
        if any(part in name for part in feed.without) or (feed.years and (not folders or folders[0] not in map(str, feed.years))):
            continue
        if feed.folder_part is None or any(feed.folder_part in f for f in folders[bool(feed.years):]):
            out.append(path)
    return out


def by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Files with the same header line, from one job over all of them (a line
    a file comes back; files without a line are left out)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")) \
        .where("start = 0").withColumn("n", F.monotonically_increasing_id())
    first = lines.groupBy("path").agg(F.min_by("value", "n").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("path").collect():
        groups.setdefault(r.header.strip("\ufeff\r"), []).append(unquote(r.path))  # the metadata column holds an encoded URI
    return list(groups.values())


def read_feed(spark: SparkSession, folder: str, feed: Feed) -> DataFrame | None:
    """S2-S6 + X1: the feed's files, one read for each layout, hook applied
    to each (as the reference: a file failing its hook's checks contributes
    nothing while the others load), then a union by column name."""
    paths = feed_files(spark, folder, feed)
    if not paths:
        return None
    if feed.fmt == "json":
        reads = [IG.read_json_documents(spark, paths, feed.schema)]
    else:
        reads = [IG.read_delimited(spark, some, sep=feed.sep) for some in by_header(spark, paths)]
    # a refused layout adds neither rows nor columns
    reads = [df for df in reads if feed.required <= {c.strip().lower() for c in df.columns}
             and (feed.kind is None or statement_kind(df)[0] == feed.kind)]
    frames = [df.transform(feed.hook) if feed.hook else df for df in reads]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def ingest_feeds(spark: SparkSession, folder: str, target_root: str, as_of: str,
                 feeds: list[Feed] = FEEDS) -> dict[str, int]:
    """Every feed with files in ``folder`` is ingested (K1) into its
    append-only table under ``target_root``; returns the written epochs.
    The same files on the same day are a replay and change nothing."""
    written = {}
    for feed in feeds:
        df = read_feed(spark, folder, feed)
        if df is None:
            continue
        names = hashlib.sha256("\n".join(feed_files(spark, folder, feed)).encode()).hexdigest()
        epoch = AT.insert(spark, os.path.join(target_root, feed.target), df, as_of, f"{as_of} {names}")
        if epoch is not None:
            written[feed.target] = epoch
    return written
