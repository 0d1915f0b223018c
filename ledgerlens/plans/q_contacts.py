"""Client/phone and contact-history load queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators import contacts as CT
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.q_reconcile import cpf_mask_sql
from ledgerlens.plans.registry import query
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources import month_store as MS
from ledgerlens.sources import fixtures as X

EXCLUDED = ["user3", "user7"]
_EXC = ", ".join(f"'{x}'" for x in EXCLUDED)


def _last11(x: str) -> str:
    d = f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) >= 11 THEN right({d}, 11) END"


_TAIL = "CASE WHEN strpos(texto, '>(') > 0 THEN trim(substr(texto, strpos(texto, '>('))) ELSE '' END"
_PHONE = (f"CASE WHEN texto IS NOT NULL THEN replace(substr({_TAIL}, 3, 2), '<', '') || "
          f"replace(substr({_TAIL}, 6, 9), '<', '') END")

HIST_SQL = with_fixtures(f"""
SELECT t.id AS telemarketing_id, {cpf_mask_sql('CAST(t.relacao_id AS VARCHAR)')} AS cliente_id,
       {_last11(_PHONE)} AS telefone_id, 'STATUS ' || CAST(t.status_telemarketing_id AS VARCHAR) AS status_tabulacao,
       t.dataregistro AS data_tabulacao, strftime(t.dataregistro, '%Y-%m') AS mes
FROM telemarketing_textos t JOIN usuario u ON u.id = t.usuario_id
WHERE t.relacao = 'cliente' AND u.login NOT IN ({_EXC})""", ["telemarketing_textos", "usuario"])


@query("historico_contatos", HIST_SQL)
def historico_contatos(spark, sf_dir):
    return CT.contact_history(X.telemarketing_texts(spark, sf_dir), X.staff_users(spark, sf_dir), EXCLUDED)


_LPAD_USER = "lpad(CAST(user_id AS VARCHAR), 11, '0')"
NOVOS_SQL = with_fixtures(f"""
WITH existing AS (
  SELECT DISTINCT {cpf_mask_sql('id')} AS cliente_id, coalesce(celular, telefone) AS telefone_id FROM clientes
  WHERE coalesce(celular, telefone) IS NOT NULL AND length(coalesce(celular, telefone)) = 11),
inc AS (
  SELECT DISTINCT {cpf_mask_sql(_LPAD_USER)} AS cliente_id,
         {_last11('telefone')} AS telefone_id
  FROM negociacao_cockpit),
ok AS (SELECT * FROM inc WHERE cliente_id IS NOT NULL AND telefone_id IS NOT NULL
       AND length(telefone_id) = 11 AND length(cliente_id) = 14)
SELECT * FROM existing
UNION ALL
SELECT * FROM ok WHERE (cliente_id, telefone_id) NOT IN (SELECT (cliente_id, telefone_id) FROM existing)""",
    ["clientes", "negociacao_cockpit"])


@query("novos_contatos", NOVOS_SQL)
def novos_contatos(spark, sf_dir):
    """Lead (CPF, phone) pairs loaded into the client-phone table
    (insert-if-absent) over the registry's existing pairs."""
    cl = X.clients(spark, sf_dir)
    phone = F.coalesce(F.col("celular"), F.col("telefone"))
    existing = (cl.filter(phone.isNotNull() & (F.length(phone) == 11))
                .select(S.cpf_mask(F.col("id")).alias("cliente_id"), phone.alias("telefone_id")).distinct())
    leads = X.leads(spark, sf_dir).select(X.cpf_of(F.col("user_id")).alias("cpf"), "telefone")
    return CT.load_client_phones({"cliente": existing.select(F.col("cliente_id").alias("id")),
                                  "telefone_scoring": existing.select(F.col("telefone_id").alias("id")),
                                  "cliente_telefone": existing}, leads)["cliente_telefone"]


MENSAL_SQL = with_fixtures("""
SELECT id, strftime(data_contrato, '%Y-%m') AS mes FROM producao_all
WHERE data_contrato >= TIMESTAMP '1990-01-01' AND data_contrato < TIMESTAMP '2001-09-01'""", ["producao_all"])


@query("extracao_mensal", MENSAL_SQL)
def extracao_mensal(spark, sf_dir):
    """Two runs of the month-sliced extraction; the second brings the
    months from the first one's on."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"months-{uuid.uuid4().hex}")
    source = X.production(spark, sf_dir).select("id", "data_contrato")
    for as_of in ("1996-06-15", "2001-08-02"):
        MS.extract_months(source, "data_contrato", root, as_of, first="1990-01-01")
    return MS.read_months(spark, root).select("id", F.col("mes").cast("string").alias("mes"))
