"""Hand-worked values for the scalar functions (FIXTURES.md part C)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_phone_55(spark):
    vals = ["(17) 99123-4567", "1799123456", "5517991234567", "551799123456", "5599123456", "abc", "", None,
            "11999998888.0"]
    assert _eval(spark, vals, S.phone_55) == [
        "5517991234567", "551799123456", "5517991234567", "551799123456", None, None, None, None, None]


def test_digits_and_last11(spark):
    assert _eval(spark, ["(17) 99123-4567", None, "12"], S.digits) == ["17991234567", "", "12"]
    assert _eval(spark, ["5517991234567", "1799123456"], S.last11) == ["17991234567", None]
    assert _eval(spark, ["11999998888.0", "", None], S.digits_or_null) == ["11999998888", None, None]


def test_ninth_digit_and_kind(spark):
    assert _eval(spark, ["17991234567", "1791234567", "17891234567"], S.drop_ninth_digit) == [
        "1791234567", "1791234567", "17891234567"]
    assert _eval(spark, ["17991234567", "1731234567", "123", "5517991234567"], S.phone_kind) == [
        "CELULAR", "FIXO", "INVALIDO", "CELULAR"]


def test_cpf(spark):
    vals = ["123", "12345678901", "12345678901234", "123.456.789-01", "None", None]
    assert _eval(spark, vals, S.cpf_mask) == [
        "000.000.001-23", "123.456.789-01", "123.456.789-01", "123.456.789-01", None, None]
    assert _eval(spark, vals, S.cpf_unmask) == [None, "12345678901", None, "12345678901", None, None]
    assert _eval(spark, ["123", "12345678901234"], S.cpf_zfill) == ["00000000123", "12345678901234"]


def test_money(spark):
    vals = ["R$ 1.234,56", "1.234,56", "RS 10", "abc", "", None, "1234.56"]
    got = _eval(spark, vals, S.money_text_to_decimal)
    assert got == [Decimal("1234.56"), Decimal("1234.56"), Decimal("10"), Decimal("0"), Decimal("0"), Decimal("0"),
                   Decimal("123456")]  # trap T16 kept
    assert _eval(spark, ["R$ 1.234,56", "12,5", "x"], S.numeric_text) == [None, 12.5, None]


def test_text_normalisation(spark):
    assert _eval(spark, ["  José  da   Silva ", "MARIA DOS ANJOS e SOUZA", "", None], S.clean_br_name) == [
        "jose silva", "maria anjos souza", "", ""]
    assert _eval(spark, ["Ação, Já!"], S.normalize_text) == ["acao ja"]
    assert _eval(spark, ["  joão "], S.accent_upper) == ["JOAO"]
    assert _eval(spark, ["mARIA silva"], S.capitalize_first) == ["Maria silva"]
    assert _eval(spark, ["  ana maria "], S.first_name) == ["Ana"]


def test_product_text(spark):
    t = ["CONSIG INSS - TAXA 1,85% CÓD. 123", "sem taxa", None]
    assert _eval(spark, t, S.product_rule) == ["CONSIG INSS", None, None]
    assert _eval(spark, t, S.product_rate) == [1.85, None, None]
    assert _eval(spark, t, S.product_code) == ["123", None, None]


def test_bins(spark):
    vals = [0.0, 30000.0, 30001.0, 39999.99, 40000.0, 100000.0, -1.0, None]
    assert _eval(spark, vals, S.ticket_class, "double") == [
        "NÃO SIMULADO", "Baixo", "Baixo", "Baixo", "Médio", "Muito Alto", "NÃO SIMULADO", "NÃO SIMULADO"]
    right = _eval(spark, vals, lambda c: S.bins_right_closed(c, [0, 30000, 60000], ["a", "b"]), "double")
    assert right == [None, "a", "b", "b", "b", None, None, None]  # 0 falls outside (0, 30000]
    assert _eval(spark, [-1, 0, 5, 6, 9, None], S.day_bucket, "int") == ["<D0", "D0", "D5", "D6+", "D6+", None]


def test_state_lookups(spark):
    assert _eval(spark, ["(11) 98888-7777", "5521988887777", "123", "(10) 9888-7777"], S.state_by_phone) == [
        "SP", "RJ", None, None]
    assert _eval(spark, ["sp", "XX", None], S.state_name) == ["SAO PAULO", "XX", None]


def test_business_days(spark):
    # 2024-01-31 is a Wednesday
    df = spark.createDataFrame([(dt.date(2024, 1, 29), dt.date(2024, 1, 31)),
                                (dt.date(2024, 1, 27), dt.date(2024, 1, 29)),
                                (dt.date(2024, 1, 26), dt.date(2024, 2, 5))], "a date, b date")
    got = [r[0] for r in df.select(D.business_days_between(F.col("a"), F.col("b"))).collect()]
    assert got == [2, 0, 6]
    d = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 1, 29),), (dt.date(2024, 1, 27),),
                               (dt.date(2024, 1, 28),)], "d date")
    got = [r[0] for r in d.select(D.minus_business_days(F.col("d"), 2)).collect()]
    # Wed-2 = Mon; Mon-2 = Thu; Sat-2 = Thu; Sun-2 = Thu (pandas BDay)
    assert got == [dt.date(2024, 1, 29), dt.date(2024, 1, 25), dt.date(2024, 1, 25), dt.date(2024, 1, 25)]


def test_business_days_additive(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), dt.date(2024, 1, 1) + dt.timedelta(days=i + j),
             dt.date(2024, 1, 1) + dt.timedelta(days=i + j + k)) for i in range(7) for j in range(9) for k in range(5)]
    df = spark.createDataFrame(rows, "a date, b date, c date")
    bad = df.filter(D.business_days_between(F.col("a"), F.col("c"))
                    != D.business_days_between(F.col("a"), F.col("b")) + D.business_days_between(F.col("b"), F.col("c")))
    assert bad.count() == 0


def test_complete_months_trap_t1(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 29)),
                                (dt.datetime(2024, 1, 15), dt.datetime(2024, 3, 15))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(D.complete_months(F.col("a"), F.col("b"))).collect()] == [0, 2]


def test_day_first_dates_trap_t2(spark):
    got = _eval(spark, ["5/3/2024", "05/03/2024", "31/02/2024", "x"], D.parse_day_first)
    assert got == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), None, None]


def test_month_and_elapsed_math_ignore_session_time_zone(spark):
    """Wall-clock (NTZ) arithmetic must not move when the session zone has a
    DST gap at midnight (Brazil, 1995-10-15)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("1995-10-15 00:00:00", "1995-11-15 00:00:00")], "a string, b string").select(
            F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))
        r = df.select(D.complete_months("a", "b").alias("m"), D.elapsed_days(F.col("b"), F.col("a")).alias("d")).first()
        assert (r.m, r.d) == (1, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_accents_beyond_latin_1(spark):
    from ledgerlens.functions import scalars as S

    rows = [("Ńowak",), ("Šilva",), ("Ưng Ệ",), ("José ÇÃO",), ("straße ø",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(S.accent_upper("t")).collect()]
    assert got == ["NOWAK", "SILVA", "UNG E", "JOSE CAO", "STRAE"]


def test_stored_null_words_are_exact(spark):
    from ledgerlens.functions import scalars as S

    words = ["nan", "NaT", "None", "NULL", "none", "nat", "", "NaN", "x"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "t string").select(S.null_words_to_null("t")).collect()]
    assert got == [None, None, None, "NULL", "none", "nat", "", "NaN", "x"]


def test_monthly_cutoff_at_month_ends(spark):
    from ledgerlens.functions import dates as D

    days = ["2024-02-10", "2023-02-28", "2024-01-31", "2024-04-30", "2024-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("CAST(d AS DATE) AS d")
    for limit, want in ((31, ["2024-02-29", "2023-02-28", "2024-01-31", "2024-04-30", "2024-12-31"]),
                        (30, ["2024-02-29", "2023-02-28", "2024-02-29", "2024-04-30", "2025-01-30"])):
        assert [str(r[0]) for r in df.select(D.monthly_cutoff("d", limit)).collect()] == want
