"""Column expressions shared by the loads. All of them are built-in Spark functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from stardw.functions import labels as L


def _bracket(value: Column, bounds, above: str) -> Column:
    out = None
    for bound, label in bounds:
        out = (F if out is None else out).when(value < F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(above))


def age_bracket(birth: Column, as_of: Column) -> Column:
    """Bracket of the difference in calendar years; an unknown birth date has its own label."""
    years = F.year(as_of) - F.year(birth)
    return F.when(birth.isNull(), F.lit(L.AGE_UNKNOWN)).otherwise(
        _bracket(years, L.AGE_BRACKETS, L.AGE_ABOVE))


def salary_bracket(salary: Column) -> Column:
    """Bracket of the salary; NULL meets no bound and falls in the open bracket."""
    return _bracket(salary, L.SALARY_BRACKETS, L.SALARY_ABOVE)


def contract_status(contract_id: Column, end: Column, as_of: Column) -> Column:
    return (F.when(contract_id.isNull(), F.lit(L.CONTRACT_NONE))
            .when(end.isNull() | (end >= as_of), F.lit(L.CONTRACT_ACTIVE))
            .otherwise(F.lit(L.CONTRACT_EXPIRED)))


def season(day: Column) -> Column:
    out = None
    for label, months in L.SEASONS[:-1]:
        out = (F if out is None else out).when(F.month(day).isin(months), F.lit(label))
    return out.otherwise(F.lit(L.SEASONS[-1][0]))


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic rather than by formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(date_key_col: Column) -> Column:
    """yyyymm of a date key: the partition column of the fact."""
    return F.floor(date_key_col / F.lit(100)).cast("int")


def full_name(last: Column, first: Column) -> Column:
    """'last first', NULL if either part is NULL, cut to the width of the column."""
    return F.left(F.concat(last, F.lit(" "), first), F.lit(L.FULL_NAME_LENGTH))


def row_hash(columns: Sequence[Column], *, utf16: bool = False) -> Column:
    """SHA-256 of the '|'-joined fields; a NULL field drops out unless it is :func:`or_empty`.

    ``utf16`` gives the upper-case digest of the UTF-16LE bytes, for comparing with hashes made
    elsewhere on wide character columns.
    """
    joined = F.concat_ws("|", *columns)
    if utf16:
        return F.upper(F.sha2(F.encode(joined, "UTF-16LE"), 256))
    return F.sha2(joined, 256)


def or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def flag_text(col: Column) -> Column:
    """Boolean as '0' / '1'."""
    return col.cast("int").cast("string")


def measures(qty: Column, price: Column, cost: Column, rate: Column) -> dict[str, Column]:
    """The five additive amounts, each rounded once, half up, from its exact value."""
    gross, goods = qty * price, qty * cost
    net = gross * (F.lit(1).cast("decimal(1,0)") - rate)
    exact = {
        "montant_brut": gross,
        "montant_remise": gross * rate,
        "montant_net": net,
        "montant_cout": goods,
        "montant_marge": net - goods,
    }
    return {name: col.cast("decimal(14,2)").alias(name) for name, col in exact.items()}


def card_number(number: Column, prefix: str = L.CARD_PREFIX) -> Column:
    """Loyalty card number: prefix and eight digits."""
    return F.format_string(f"{prefix}-%08d", number)


def bulk_text(col: Column) -> Column:
    """Text made safe for a tab-separated bulk file: doubled backslashes, no tab or newline."""
    doubled = F.replace(col.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.translate(doubled, "\t\n", "  ")


def register_sql_functions(spark: SparkSession) -> None:
    """The two bracket functions for analysts who write SQL."""
    def case(value: str, bounds, above: str) -> str:
        arms = " ".join(f"WHEN {value} < {bound} THEN '{label}'" for bound, label in bounds)
        return f"CASE {arms} ELSE '{above}' END"

    age = case("year(jour) - year(naissance)", L.AGE_BRACKETS, L.AGE_ABOVE)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_tranche_age(naissance DATE, jour DATE)
                  RETURNS STRING
                  RETURN CASE WHEN naissance IS NULL THEN '{L.AGE_UNKNOWN}' ELSE {age} END""")
    pay = case("salaire", L.SALARY_BRACKETS, L.SALARY_ABOVE)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_tranche_salaire(salaire DECIMAL(12,2))
                  RETURNS STRING RETURN {pay}""")
