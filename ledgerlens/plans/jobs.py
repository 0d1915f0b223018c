"""The reference's scheduled task orders as plain driver functions
(orchestration re-aim): commissions (extract → reconcile → report →
write-back) and growth (files → cohort tables).  Scheduling and retries
belong to whatever runs these; every step is idempotent (versioned
outputs, hash-keyed ingestion), so a retried run is safe.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlens.operators import reconcile as RC
from ledgerlens.operators import retention as R
from ledgerlens.operators import sla as SL
from ledgerlens.session import cut_lineage
from ledgerlens.sources import feeds as FD
from ledgerlens.sources import fixtures as X
from ledgerlens.sources import writers as W


def commission_job(spark: SparkSession, sf_dir: str, out_root: str, as_of: str, start_date: str) -> dict:
    """Reconcile partner statements against production, write the report
    set and the production write-back (a new version, never in place)."""
    st = cut_lineage(RC.prepare_statements(X.bank_statements(spark, sf_dir)), "statements")
    prod = RC.prepare_production(RC.production_in_span(X.production(spark, sf_dir), st))
    pairs = RC.staged_pairing(st, prod, left_held=True)
    paired = RC.paired_statements(st, pairs)
    best = RC.effective_rate(paired, X.rate_table(spark, sf_dir))
    rec = RC.expected_commission(paired, best)
    written_back = RC.production_write_back(prod, pairs, rec, start_date)
    due = SL.awaiting_payment(X.bank_statements(spark, sf_dir), start_date)
    payments = SL.payment_status(SL.expected_payment_date(due, SL.sla_rules(spark)), as_of)
    frames = {
        **RC.commission_blocks(st, as_of, start_date),
        "CONVENIOS": RC.agreement_similarity(st, prod, pairs),
        "PAGAMENTOS": payments,
        "RESUMO": RC.stage_summary(pairs),
        "NAO_ENCONTRADOS_BANCOS": RC.unmatched(st, pairs, "src_id"),
        "NAO_ENCONTRADOS_ECB": RC.unmatched(prod, pairs, "id"),
        "REPORT": RC.report(st, prod, pairs, payments, as_of, start_date),
        "PRODUCAO_ATUALIZADA": written_back,
    }
    return W.write_report_set(frames, out_root)


def growth_job(spark: SparkSession, sf_dir: str, files_folder: str | None, out_root: str, as_of: str) -> dict:
    """Ingest any partner files waiting in ``files_folder``, then refresh
    the cohort and retention tables."""
    written = FD.ingest_feeds(spark, files_folder, f"{out_root}/tables", as_of) if files_folder else {}
    prod = X.production(spark, sf_dir)
    frames = {"SAFRA": R.cohort_table(prod), "RETENCAO": R.retention_curve(prod)}
    written.update(W.write_report_set(frames, f"{out_root}/reports"))
    return written
