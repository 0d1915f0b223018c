"""Calendar and SLA rules (F43-F46, C10-C11), hand-worked."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import calendar as C
from ledgerlens.operators import sla as SL


def test_easter_and_holidays(spark):
    df = spark.createDataFrame([(2024,), (2025,), (2000,)], "y int")
    got = [r[0] for r in df.select(C.easter_sunday(F.col("y"))).collect()]
    assert got == [dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2000, 4, 23)]
    hol = {r.data for r in C.holidays(spark, 2024, 2024).collect()}
    assert dt.date(2024, 3, 29) in hol and dt.date(2024, 11, 20) in hol and dt.date(2024, 12, 25) in hol


def test_calendar_ordinal(spark):
    cal = C.calendar(spark, "2024-03-25", "2024-04-05").collect()
    util = {r.data: r.util for r in cal}
    assert util[dt.date(2024, 3, 29)] is False  # Good Friday
    assert util[dt.date(2024, 3, 30)] is False  # Saturday
    ords = {r.data: r.ordinal for r in cal}
    assert ords[dt.date(2024, 4, 1)] - ords[dt.date(2024, 3, 28)] == 1  # Fri holiday + weekend skipped


def _expected(spark, rows, config):
    df = spark.createDataFrame(rows, "id int, nom_banco string, tipo_operacao string, dat_credito timestamp_ntz")
    out = SL.expected_payment_date(df, SL.sla_rules(spark, config))
    return {r.id: r.data_esperada_pgto for r in out.collect()}


def test_sla_kinds(spark):
    config = {
        "DU": {"tipo_sla": "dias_uteis", "dias": 2},
        "DC": {"tipo_sla": "dias_corridos", "dias": 5},
        "WD": {"tipo_sla": "dia_semana", "dia_semana": "quarta"},
        "BAD": {"tipo_sla": "dia_semana", "dia_semana": "sabado"},
        "M": {"tipo_sla": "mensal", "dia_limite": 16},
        "LIM": {"tipo_sla": "dias_corridos", "dias": 1,
                "regras_extras": {"data_limite": 25, "acao_pos_limite": "adicionar_dias"}},
        "POST": {"tipo_sla": "dias_corridos", "dias": 1,
                 "regras_extras": {"data_limite": 25, "acao_pos_limite": "adiar_pagamento"}},
    }
    thu = dt.datetime(2024, 3, 28)  # Thursday before Good Friday
    rows = [(1, "DU", None, thu), (2, "DC", None, thu), (3, "WD", None, thu), (4, "BAD", None, thu),
            (5, "M", None, thu), (6, "LIM", None, dt.datetime(2024, 3, 26)), (7, "POST", None, thu),
            (8, "OTHER", None, thu), (9, "DU", None, None)]
    got = _expected(spark, rows, config)
    assert got[1] == dt.date(2024, 4, 2)    # Fri holiday, weekend -> Mon, Tue
    assert got[2] == dt.date(2024, 4, 2)
    assert got[3] == dt.date(2024, 4, 3)    # next Wednesday
    assert got[4] is None                    # no recognised weekday (trap T22)
    assert got[5] == dt.date(2024, 4, 16)   # past day 16 -> next month
    assert got[6] == dt.date(2024, 3, 29)   # +1 day before, +1 day at the end (trap T18)
    assert got[7] is None                    # postponed
    assert got[8] == dt.date(2024, 4, 1)    # unknown bank: next business day
    assert got[9] is None
