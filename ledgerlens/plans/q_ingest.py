"""Ingestion queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.session import cut_lineage, ensure_checkpoint_dir
from ledgerlens.sources import append_table as AT
from ledgerlens.sources import fixtures as X
from ledgerlens.sources import ingest as IG

AS_OF = "2001-08-02"
PRIOR = "2001-07-01"
_COLS = ["src_id", "nom_banco", "num_proposta", "num_contrato", "cliente_id", "val_liberado", "dat_emprestimo",
         "status_producao", "dsc_produto"]


def _statement_file(spark, sf_dir):
    """The partner file as received: statement columns with display names."""
    s = X.bank_statements(spark, sf_dir).select(*_COLS)
    return s.toDF(*[c.upper().replace("_", " ") for c in _COLS])


_TXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _COLS)
_HASH = "sha256(concat_ws(chr(31), " + ", ".join(f"coalesce({c}, '')" for c in sorted(_COLS)) + "))"
_INC = f"SELECT DISTINCT {_TXT} FROM contratos_bancos"
INGEST_SQL = with_fixtures(f"""
WITH h AS (SELECT *, {_HASH} AS row_hash FROM ({_INC}))
SELECT src_id, nom_banco, row_hash,
       CASE WHEN nom_banco IN ('BANCO SANTANDER', 'BANCO PAN') THEN DATE '{PRIOR}' ELSE DATE '{AS_OF}' END AS execution_date,
       CASE WHEN nom_banco IN ('BANCO SANTANDER', 'BANCO PAN') THEN TIMESTAMP '{AS_OF} 00:00:00' END AS verificacao_hash
FROM h""", ["contratos_bancos"])


@query("ingest_idempotente", INGEST_SQL, headline=True)
def ingest_idempotente(spark, sf_dir):
    """K1 + F30: a statement file ingested into a table that already holds
    two banks' rows from an earlier run: those rows are only touched, the
    rest are inserted once (whole-row duplicates collapse)."""
    # a received file exists on disk once; the prior run and this one read it
    incoming = cut_lineage(_statement_file(spark, sf_dir), "statement-file")
    prior = IG.idempotent_insert(None, incoming.filter(F.col("NOM BANCO").isin("BANCO SANTANDER", "BANCO PAN")), PRIOR)
    out = IG.idempotent_insert(prior, incoming, AS_OF)
    return out.select("src_id", "nom_banco", "row_hash", "execution_date", "verificacao_hash")


@query("ingest_incremental", INGEST_SQL)
def ingest_incremental(spark, sf_dir):
    """K1 + K2 + R1's sink: the same two loads into the append-only table:
    the second writes its own rows, and touches stand beside the first's."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"statements-{uuid.uuid4().hex}")
    incoming = cut_lineage(_statement_file(spark, sf_dir), "statement-file")
    AT.insert(spark, root, incoming.filter(F.col("NOM BANCO").isin("BANCO SANTANDER", "BANCO PAN")), PRIOR, "prior")
    AT.insert(spark, root, incoming, AS_OF, "now")
    return AT.read(spark, root).select("src_id", "nom_banco", "row_hash", "execution_date", "verificacao_hash")
