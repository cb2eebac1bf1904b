import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stardw.functions import exprs as E
from stardw.plans.dimensions import date_dimension
from stardw.session import local_rows


def one(df):
    return [r[0] for r in df.collect()]


def test_age_brackets(spark):
    births = [None, date(1977, 12, 31), date(1976, 1, 1), date(1967, 6, 1), date(1966, 6, 1),
              date(1937, 1, 1), date(1936, 12, 31)]
    df = local_rows(spark, [(i, b) for i, b in enumerate(births)], "i int, d date").orderBy("i")
    got = one(df.select(E.age_bracket(F.col("d"), F.lit(date(2001, 12, 31)))))
    assert got == ["inconnu", "<25", "25-34", "25-34", "35-44", "55-64", ">=65"]


def test_salary_brackets(spark):
    pays = [Decimal(p) for p in ("29999.99", "30000", "50000", "80000", "120000")] + [None]
    df = local_rows(spark, [(i, p) for i, p in enumerate(pays)],
                    "i int, p decimal(12,2)").orderBy("i")
    assert one(df.select(E.salary_bracket(F.col("p")))) == [
        "<30k", "30-50k", "50-80k", "80-120k", ">=120k", ">=120k"]


def test_sql_functions_agree(spark):
    E.register_sql_functions(spark)
    row = spark.sql("select fn_tranche_age(date'1976-01-01', date'2001-12-31') a, "
                    "fn_tranche_age(null, date'2001-12-31') b, "
                    "fn_tranche_salaire(80000.00) c, fn_tranche_salaire(null) d").first()
    assert tuple(row) == ("25-34", "inconnu", "80-120k", ">=120k")


def test_measures_round_each_amount_on_its_own(spark):
    df = local_rows(spark, [(Decimal("3.000"), Decimal("10.55"), Decimal("7.01"),
                             Decimal("0.0750"))],
                    "q decimal(12,3), p decimal(12,2), c decimal(12,2), r decimal(5,4)")
    row = df.select(*E.measures(*[F.col(x) for x in "qpcr"]).values()).first()
    assert [str(v) for v in row] == ["31.65", "2.37", "29.28", "21.03", "8.25"]


def test_measures_hold_the_widest_values(spark):
    df = local_rows(spark, [(Decimal("999999999.999"), Decimal("999.99"), Decimal("0.01"),
                             Decimal("1.0000"))],
                    "q decimal(12,3), p decimal(12,2), c decimal(12,2), r decimal(5,4)")
    row = df.select(*E.measures(*[F.col(x) for x in "qpcr"]).values()).first()
    assert str(row.montant_brut) == "999989999999.00" and str(row.montant_net) == "0.00"


@pytest.mark.parametrize("day,weekday,week,name,season", [
    (date(2000, 1, 1), 6, 52, "Saturday", "Hiver"), (date(1999, 1, 4), 1, 1, "Monday", "Hiver"),
    (date(2000, 12, 31), 7, 52, "Sunday", "Hiver"), (date(2000, 8, 31), 4, 35, "Thursday", "Été"),
    (date(2000, 3, 1), 3, 9, "Wednesday", "Printemps")])
def test_date_dimension(spark, day, weekday, week, name, season):
    row = date_dimension(spark, day, day).first()
    assert (row.jour_de_semaine, row.semaine_annee, row.nom_jour, row.saison) == (
        weekday, week, name, season)
    assert row.est_weekend == (weekday > 5)
    assert row.cle_date == int(day.strftime("%Y%m%d"))


def test_usual_date_span(spark):
    assert date_dimension(spark, date(1997, 1, 1), date(2003, 12, 31)).count() == 2556


def test_hash_and_null_rules(spark):
    df = local_rows(spark, [("a", None, True)], "x string, y string, z boolean")
    empty, dropped, wide = df.select(
        E.row_hash([F.col("x"), E.or_empty(F.col("y")), E.flag_text(F.col("z"))]),
        E.row_hash([F.col("x"), F.col("y")]),
        E.row_hash([F.col("x")], utf16=True)).first()
    assert empty == hashlib.sha256(b"a||1").hexdigest()
    assert dropped == hashlib.sha256(b"a").hexdigest()
    assert wide == hashlib.sha256("a".encode("utf-16-le")).hexdigest().upper()


def test_full_name(spark):
    df = local_rows(spark, [("A", None), ("A", "B"), ("N" * 100, "P" * 100)],
                    "n string, p string")
    got = one(df.select(E.full_name(F.col("n"), F.col("p"))))
    assert got[:2] == [None, "A B"] and len(got[2]) == 160


def test_texts(spark):
    df = local_rows(spark, [("a\\b\tc\nd", 42)], "t string, n bigint")
    assert tuple(df.select(E.bulk_text(F.col("t")), E.card_number(F.col("n"))).first()) == (
        "a\\\\b c d", "OSC-00000042")
