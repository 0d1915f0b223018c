"""Rate-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators import rates as RT
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.sources import fixtures as X

AS_OF_RATES = "2024-07-01"
BANK = X.RATES_BANK


def _part(c: str) -> str:
    t = f"trim(CAST({c} AS VARCHAR))"
    return f"CASE WHEN {t} IS NOT NULL AND {t} <> '' AND lower({t}) <> 'nan' THEN {t} END"


_DIFF = f"""
nf AS (
  SELECT concat_ws('-', {_part('codigo_regra')}, {_part('range_faixa')}, {_part('faixa_parcela')}) AS codigo_regra,
         descricao_regra, faixa_parcela, taxa_juros_sem_seguro, taxa_juros_com_seguro, percentual_comissao_a_vista
  FROM arquivo_taxas),
old AS (
  SELECT id, codigo AS codigo_regra, descricao_banco AS descricao_regra,
         regexp_replace(CAST(prazo AS VARCHAR), '^0+', '') AS faixa_parcela,
         taxa_total AS taxa_juros_sem_seguro, taxa_vista AS taxa_juros_com_seguro,
         comissao_total AS percentual_comissao_a_vista
  FROM tabela_taxas_hist WHERE data_fim IS NULL AND banco = '{BANK}'),
diff AS (
  SELECT n.codigo_regra AS n_codigo_regra, n.faixa_parcela AS n_faixa_parcela, n.descricao_regra AS n_descricao_regra,
         n.taxa_juros_sem_seguro AS n_taxa_juros_sem_seguro, n.taxa_juros_com_seguro AS n_taxa_juros_com_seguro,
         n.percentual_comissao_a_vista AS n_perc, o.id, o.codigo_regra AS o_codigo_regra, o.faixa_parcela AS o_faixa_parcela,
         CASE WHEN (n.codigo_regra IS NOT NULL OR n.faixa_parcela IS NOT NULL) AND o.id IS NULL THEN 'NOVA'
              WHEN NOT (n.codigo_regra IS NOT NULL OR n.faixa_parcela IS NOT NULL) AND o.id IS NOT NULL THEN 'REMOVIDA'
              WHEN n.codigo_regra IS NOT DISTINCT FROM o.codigo_regra AND n.descricao_regra IS NOT DISTINCT FROM o.descricao_regra
               AND n.faixa_parcela IS NOT DISTINCT FROM o.faixa_parcela
               AND n.taxa_juros_sem_seguro IS NOT DISTINCT FROM o.taxa_juros_sem_seguro
               AND n.taxa_juros_com_seguro IS NOT DISTINCT FROM o.taxa_juros_com_seguro
               AND n.percentual_comissao_a_vista IS NOT DISTINCT FROM o.percentual_comissao_a_vista THEN 'IGUAL'
              ELSE 'ALTERADA' END AS status
  FROM nf n FULL OUTER JOIN old o
    ON n.codigo_regra IS NOT DISTINCT FROM o.codigo_regra AND n.faixa_parcela IS NOT DISTINCT FROM o.faixa_parcela)"""

_FIX = ["tabela_taxas_hist", "arquivo_taxas"]

DIFF_SQL = with_fixtures(f"""WITH {_DIFF}
SELECT coalesce(n_codigo_regra, o_codigo_regra) AS codigo_regra, coalesce(n_faixa_parcela, o_faixa_parcela) AS faixa_parcela,
       id, status FROM diff""", _FIX)


@query("diff_taxas", DIFF_SQL)
def diff_taxas(spark, sf_dir):
    d = RT.table_diff(RT.normalise_new_file(X.new_rate_file(spark, sf_dir)),
                      RT.current_versions(X.rate_history(spark, sf_dir), BANK))
    return d.select(F.coalesce("n_codigo_regra", "o_codigo_regra").alias("codigo_regra"),
                    F.coalesce("n_faixa_parcela", "o_faixa_parcela").alias("faixa_parcela"), "id", "status")


SCD2_SQL = with_fixtures(f"""WITH {_DIFF},
closed AS (SELECT id FROM diff WHERE status IN ('ALTERADA', 'REMOVIDA'))
SELECT h.id, h.codigo, h.descricao_banco, h.prazo, h.taxa_total, h.taxa_vista, h.comissao_total, h.comissao_vista,
       h.banco, h.data_inicio,
       CASE WHEN c.id IS NOT NULL THEN CAST(DATE '{AS_OF_RATES}' - INTERVAL 1 DAY AS DATE) ELSE h.data_fim END AS data_fim
FROM tabela_taxas_hist h LEFT JOIN closed c ON h.id = c.id
UNION ALL
SELECT CAST(NULL AS BIGINT), n_codigo_regra, n_descricao_regra, n_faixa_parcela, n_taxa_juros_sem_seguro,
       n_taxa_juros_com_seguro,
       CASE WHEN n_perc < 0.5 THEN n_perc ELSE n_perc * 0.8 END,
       CASE WHEN n_perc < 0.5 THEN n_perc ELSE n_perc * 0.8 END,
       '{BANK}', DATE '{AS_OF_RATES}', CAST(NULL AS DATE)
FROM diff WHERE status IN ('NOVA', 'ALTERADA')""", _FIX)


@query("scd2_taxas", SCD2_SQL, headline=True)
def scd2_taxas(spark, sf_dir):
    out = RT.scd2_apply(X.rate_history(spark, sf_dir), X.new_rate_file(spark, sf_dir), AS_OF_RATES, BANK)
    return out.select("id", "codigo", "descricao_banco", "prazo", "taxa_total", "taxa_vista", "comissao_total",
                      "comissao_vista", "banco", "data_inicio", "data_fim")


# the file as received names two thirds of its rules again, later, with other rates
REPETIDAS_SQL = SCD2_SQL.replace("nf AS (", """nf AS (
  SELECT * REPLACE (CASE WHEN left(md5(codigo_regra), 1) < 'b' THEN percentual_comissao_a_vista / 2 ELSE percentual_comissao_a_vista END AS percentual_comissao_a_vista) FROM (""", 1).replace("FROM arquivo_taxas),", "FROM arquivo_taxas)),", 1)


@query("scd2_repetidas", REPETIDAS_SQL)
def scd2_repetidas(spark, sf_dir):
    """D4 + K13: a file that names rules twice: the later row counts."""
    first = X.new_rate_file(spark, sf_dir)
    again = first.withColumn("_code", RT.unique_code("codigo_regra", "range_faixa", "faixa_parcela")).filter(F.substring(F.md5("_code"), 1, 1) < "b") \
        .drop("_code").withColumn("percentual_comissao_a_vista", F.col("percentual_comissao_a_vista") / 2)
    file = first.withColumn("posicao", F.lit(1)).unionByName(again.withColumn("posicao", F.lit(2)))
    out = RT.scd2_apply(X.rate_history(spark, sf_dir), file, AS_OF_RATES, BANK, position="posicao")
    return out.select("id", "codigo", "descricao_banco", "prazo", "taxa_total", "taxa_vista", "comissao_total",
                      "comissao_vista", "banco", "data_inicio", "data_fim")


ATUAL_SQL = with_fixtures(f"WITH {_DIFF} SELECT * FROM old", _FIX)


@query("taxas_atuais", ATUAL_SQL)
def taxas_atuais(spark, sf_dir):
    return RT.current_versions(X.rate_history(spark, sf_dir), BANK)


SPLIT_SQL = with_fixtures("""
SELECT codigo_regra, percentual_comissao_a_vista,
       CASE WHEN percentual_comissao_a_vista < 0.5 THEN percentual_comissao_a_vista
            ELSE percentual_comissao_a_vista * 0.8 END AS comissao_total
FROM arquivo_taxas""", ["arquivo_taxas"])


@query("comissao_split", SPLIT_SQL)
def comissao_split(spark, sf_dir):
    f = X.new_rate_file(spark, sf_dir)
    return f.select("codigo_regra", "percentual_comissao_a_vista",
                    S.commission_split(F.col("percentual_comissao_a_vista")).alias("comissao_total"))
