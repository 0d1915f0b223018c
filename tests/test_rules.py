"""Lead rules C1-C7 on hand-made rows (as_of Wednesday 2024-01-31 00:00)."""

from pyspark.sql import functions as F

from ledgerlens.operators import leads as L

AS_OF = "2024-01-31 00:00:00"
SCHEMA = ("id int, desclassificado boolean, enviado int, abriu_regua string, data_chegada timestamp_ntz, "
          "valor double, veiculo string, data_insercao timestamp_ntz, genero string, tipo_veiculo string, "
          "qtd_3_meses long, classificacao_ticket string, semelhanca_nomes int, canal string, ano string, "
          "telefone string, propostas_enviadas_minha_loja int, tipo_lead string")


def _rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string"))
    return (df.withColumn("data_chegada", F.to_timestamp_ntz("data_chegada"))
            .withColumn("data_insercao", F.to_timestamp_ntz("data_insercao")))


def _base(**kw):
    row = dict(id=0, desclassificado=False, enviado=None, abriu_regua="SIM", data_chegada="2024-01-30 10:00:00",
               valor=20000.0, veiculo="X", data_insercao="2024-01-30 10:00:00", genero=None, tipo_veiculo="CARRO",
               qtd_3_meses=1, classificacao_ticket="Baixo", semelhanca_nomes=50, canal="C2C", ano="2020/2021",
               telefone="11999999999", propostas_enviadas_minha_loja=0, tipo_lead=None)
    row.update(kw)
    return tuple(row[k] for k in [c.split()[0] for c in SCHEMA.split(", ")])


def test_priority_by_ticket(spark):
    rows = [_base(id=1, desclassificado=True), _base(id=2), _base(id=3, valor=50000.0),
            _base(id=4, valor=90000.0), _base(id=5, data_chegada="2024-01-20 10:00:00"),
            _base(id=6, valor=90000.0, abriu_regua="NAO")]
    got = {r.id: r.p for r in _rows(spark, rows).select("id", L.priority_by_ticket(AS_OF).alias("p")).collect()}
    # recovery (6) needs recent arrival, a vehicle, insertion >= 3 h before as_of and ruler != NAO
    assert got == {1: 10, 2: 1, 3: 2, 4: 6, 5: 10, 6: 10}


def test_priority_by_audience(spark):
    rows = [_base(id=1, genero="M", tipo_veiculo="MOTO"), _base(id=2, genero="F", tipo_veiculo="MOTO"),
            _base(id=3, genero="M"), _base(id=4, genero="F"), _base(id=5, qtd_3_meses=2),
            _base(id=6, enviado=1)]
    got = {r.id: r.p for r in _rows(spark, rows).select("id", L.priority_by_audience(AS_OF).alias("p")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}  # sent lead: not actionable, falls to recovery


def test_priority_current_and_lead_type(spark):
    rows = [_base(id=1, canal="APROVADO NÃO EFETIVADO"), _base(id=2), _base(id=3, valor=5000.0),
            _base(id=4, data_chegada="2024-01-20 10:00:00"), _base(id=5, ano="2010/2011"),
            _base(id=6, abriu_regua="ERRO MODELO"), _base(id=7, desclassificado=True)]
    df = _rows(spark, rows).withColumn("prioridade", L.priority_current(AS_OF))
    out = {r.id: (r.prioridade, r.t) for r in df.select("id", "prioridade", L.lead_type(AS_OF).alias("t")).collect()}
    assert out == {1: (1, "SQL"), 2: (2, "SQL"), 3: (3, "SQL"), 4: (10, "DESCARTE"), 5: (3, "SQL"),
                   6: (3, "MQL"), 7: (10, "DESCARTE")}


def test_disqualified(spark):
    rows = [_base(id=1, telefone=None), _base(id=2, qtd_3_meses=11), _base(id=3, propostas_enviadas_minha_loja=6),
            _base(id=4, propostas_enviadas_minha_loja=None), _base(id=5, qtd_3_meses=10)]
    got = {r.id: r.d for r in _rows(spark, rows).select("id", L.disqualified().alias("d")).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False}


def test_priority_base_cascade(spark):
    rows = [_base(id=1, desclassificado=True), _base(id=2, qtd_3_meses=2),
            _base(id=3, genero="M", tipo_veiculo="MOTO", classificacao_ticket="Alto"),
            _base(id=4, genero="F", tipo_veiculo="MOTO"),
            _base(id=5, abriu_regua="ERRO MODELO", semelhanca_nomes=100),
            _base(id=6), _base(id=7, semelhanca_nomes=100, canal="APROVADO"),
            _base(id=8, classificacao_ticket="Alto", abriu_regua="NAO TESTADO")]
    df = (_rows(spark, rows).withColumn("cpf", F.lit("12345678901")).withColumn("data_nascimento", F.lit("1990-01-01"))
          .withColumn("marca", F.lit("M")).withColumn("estado", F.lit("SP")))
    got = {r.id: r.p for r in df.select("id", L.priority_base(AS_OF).alias("p")).collect()}
    # 1 disqualified; 2 valid+recent+2 arrivals in 3 months; 3 male+moto; 4 moto+valid;
    # 5 ERRO MODELO with a Baixo ticket and similarity 100; 6 valid+recent; 7 complete priority-1;
    # 8 not valid (Alto ticket) but recovery applies (recent, vehicle, inserted >= 3 h before)
    assert got == {1: 10, 2: 3, 3: 5, 4: 7, 5: 4, 6: 2, 7: 1, 8: 6}
