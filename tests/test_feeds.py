"""File feeds (S2-S6, S14, P10-P12) and writers (K14-K16) on temporary files."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.sources import feeds as FD
from ledgerlens.sources import fixtures as X
from ledgerlens.sources import append_table as AT
from ledgerlens.sources import ingest as IG
from ledgerlens.sources import writers as W

from conftest import SMOKE


def _write_csv(path, header, rows, sep=";"):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            fh.write(sep.join("" if v is None else str(v) for v in r) + "\n")


def test_feed_registry_ingests_idempotently(spark):
    root = tempfile.mkdtemp(prefix="ll-feeds-")
    src = os.path.join(root, "downloads")
    os.makedirs(os.path.join(src, "2025", "fgts"))
    rows = [tuple(r) for r in X.bank_statements(spark, SMOKE).select("src_id", "nom_banco", "num_proposta").limit(50).collect()]
    _write_csv(os.path.join(src, "ProducaoMensalBD_01.csv"), ["SRC ID", "Nom Banco", "Num Proposta"], rows)
    _write_csv(os.path.join(src, "ProducaoMensalBD_02.csv"), ["SRC ID", "Nom Banco", "Num Proposta"], rows[:10])
    fg = [c for c in FD.FGTS_COLUMNS]
    _write_csv(os.path.join(src, "2025", "fgts", "uy3_jan.csv"), fg, [tuple(range(len(fg)))])
    _write_csv(os.path.join(src, "2025", "fgts", "uy3_bad.csv"), ["corban", "cliente"], [(1, 2)])
    doc = {"extratoComissaoDetalheContrato": {"contrato": {"idContrato": "C1", "vlLiquido": 10.5},
                                              "dadosCliente": {"nrCpfCnpj": "123", "nrChassi": " ABC "},
                                              "acordo": {"nrAcordo": "A1"}},
           "resumoExtratoComissaoContratoDetalhe": {"dtInicial": "2025-01-01"}}
    with open(os.path.join(src, "extrato_comissao_finveiculo_vivero_1.json"), "w") as fh:
        json.dump(doc, fh)
    target = os.path.join(root, "tables")
    w1 = FD.ingest_feeds(spark, src, target, "2025-01-02")
    assert set(w1) == {"contratos_bb", "comissao_uy3", "extrato_financeiro_vivero"}
    bb1 = AT.read(spark, os.path.join(target, "contratos_bb"))
    assert bb1.count() == 50 and "nom_banco" in bb1.columns  # whole-row duplicates across files collapse
    FD.ingest_feeds(spark, src, target, "2025-01-03")
    assert AT.read(spark, os.path.join(target, "contratos_bb")).count() == 50
    viv = AT.read(spark, os.path.join(target, "extrato_financeiro_vivero")).first()
    assert viv.nrchassi == "ABC" and viv.vlbruto == "0.0" and viv.vlliquido == "10.5"


def test_statement_kind_and_ancora(spark):
    fin = spark.createDataFrame([("a", "b", "1", "ok", "x")],
                                "`Tipo de Veículo` string, `Condição` string, `Valor Liberado` string, Status string, `Data do Extrato` string")
    kind, df = FD.statement_kind(fin)
    assert kind == "financeiro" and "data_do_extrato" not in df.columns
    cols = ["Nº Doc", "Repres", "Data", "Descrição", "Tipo", "Contrato", "Venda", "Grupo", "Cota", "Parcela",
            "Valor Base Carta de Crédito", "Valor", "Extra"]
    anc = spark.createDataFrame([("1", "r", "5/3/2025", "d", "t", "c", "05/03/2025", "g", "q", "p", "100", "9", "z")],
                                ", ".join(f"`{c}` string" for c in cols))
    out = FD.preprocess_ancora(anc, user_id=7)
    assert out.columns == list(FD.ANCORA_COLUMNS.values()) + ["usuario_insercao"]
    r = out.first()
    assert str(r.data) == "2025-03-05" and str(r.venda) == "2025-03-05" and r.usuario_insercao == 7


def test_writers(spark):
    root = tempfile.mkdtemp(prefix="ll-writers-")
    df = X.leads(spark, SMOKE).select("id", "canal", "data_chegada", "telefone").limit(100)
    paths = W.write_report_set({"REPORT NOVA": df}, os.path.join(root, "report"))
    back = spark.read.parquet(paths["REPORT NOVA"])
    assert dict(back.dtypes)["data_chegada"] == "date"
    W.write_per_group(df, os.path.join(root, "by_canal"), ["canal"])
    assert any(d.startswith("canal=") for d in os.listdir(os.path.join(root, "by_canal")))
    W.write_csv_subset(df, ["id", "telefone"], os.path.join(root, "csv"))
    assert spark.read.option("header", True).option("sep", ";").csv(os.path.join(root, "csv")).count() == 100


def test_jobs_run_end_to_end(spark):
    from ledgerlens.plans import jobs
    root = tempfile.mkdtemp(prefix="ll-jobs-")
    paths = jobs.commission_job(spark, SMOKE, os.path.join(root, "comissoes"), X.AS_OF_ORDERS, "2001-01-01")
    assert set(paths) == {"RESUMO", "NAO_ENCONTRADOS_BANCOS", "NAO_ENCONTRADOS_ECB", "COMISSAO_NULA", "COMISSAO_ZERO", "CONVENIOS",
                          "PAGAMENTOS", "REPORT", "PRODUCAO_ATUALIZADA"}
    assert spark.read.parquet(paths["RESUMO"]).count() > 0
    g = jobs.growth_job(spark, SMOKE, None, os.path.join(root, "growth"), "2001-08-02")
    assert spark.read.parquet(g["SAFRA"]).count() > 0


def test_load_file_set_tags_source_files(spark):
    root = tempfile.mkdtemp(prefix="ll-files-")
    _write_csv(os.path.join(root, "a_extrato.csv"), ["x"], [(1,), (2,)])
    _write_csv(os.path.join(root, "b_extrato.csv"), ["x"], [(3,)])
    paths = IG.find_files(spark, root, (".csv",), ["extrato"])
    df = IG.load_file_set(spark, paths, lambda s, p: IG.read_delimited(s, p),
                          preprocess=lambda d: d.withColumn("x", F.col("x").cast("int")))
    got = sorted((r.x, r.arquivo_origem) for r in df.collect())
    assert got == [(1, "a_extrato.csv"), (2, "a_extrato.csv"), (3, "b_extrato.csv")]


def test_many_files_of_three_layouts_are_three_reads(spark, tmp_path, monkeypatch):
    layouts = [["Src Id", "Nome"], ["Nome", "Src Id"], ["Src Id", "Nome", "Valor"]]
    for k in range(1000):
        cols = layouts[k % 3]
        _write_csv(str(tmp_path / f"ProducaoMensalBD_{k:04}.csv"), cols, [tuple({"Src Id": k, "Nome": f"n{k}", "Valor": 1}[c] for c in cols)])
    (tmp_path / "ProducaoMensalBD_empty.csv").write_text("")
    feed = next(f for f in FD.FEEDS if f.target == "contratos_bb")
    reads, read = [], IG.read_delimited
    monkeypatch.setattr(IG, "read_delimited", lambda spark, paths, **k: reads.append(len(paths)) or read(spark, paths, **k))
    got = FD.read_feed(spark, str(tmp_path), feed)
    rows = got.collect()
    assert sorted(reads) == [333, 333, 334] and got.columns == ["Src Id", "Nome", "Valor"]
    assert sorted((int(r["Src Id"]), r.Nome, r.Valor) for r in rows) == [(k, f"n{k}", "1" if k % 3 == 2 else None) for k in range(1000)]


def test_statements_are_typed_by_columns_and_folders_by_year(spark, tmp_path):
    fin = ["Tipo de Veículo", "Condição", "Valor Liberado", "Status", "Data do Extrato"]
    _write_csv(str(tmp_path / "extrato_jan.csv"), fin, [("carro", "novo", "10", "ok", "2025-01-01")])
    _write_csv(str(tmp_path / "my_extrato_feb.csv"), ["Contrato", "Comissao", "Data do Extrato"], [("c1", "5", "2025-02-01"), ("c2", "6", "2025-02-01")])
    row = tuple(range(len(FD.FGTS_COLUMNS)))
    for where in ("2025/lote FGTS 1", "2025/outros", "2024/fgts", "fgts"):
        os.makedirs(tmp_path / where)
        _write_csv(str(tmp_path / where / "uy3_a.csv"), FD.FGTS_COLUMNS, [(where, *row[1:])])
    target = str(tmp_path / "tables")
    done = FD.ingest_feeds(spark, str(tmp_path), target, "2025-03-01")
    assert set(done) == {"extrato_financeiro_plataforma", "extrato_comissao_plataforma", "comissao_uy3"}
    got = AT.read(spark, f"{target}/extrato_financeiro_plataforma").collect()
    assert len(got) == 1 and got[0].tipo_de_veiculo == "carro" and "data_do_extrato" not in got[0]
    assert AT.read(spark, f"{target}/extrato_comissao_plataforma").count() == 2
    assert [r.corban for r in AT.read(spark, f"{target}/comissao_uy3").collect()] == ["2025/lote FGTS 1"]
    assert FD.ingest_feeds(spark, str(tmp_path), target, "2025-03-01") == {}  # a replay
