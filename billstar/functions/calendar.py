"""Calendar attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# French day names, Monday first (ISO weekday 1..7).
DAY_NAMES_FR = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")

# French month names, January first.
MONTH_NAMES_FR = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)


def date_key(d: Column) -> Column:
    """Smart key yyyymmdd: unique per date and stable across loads."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def iso_weekday(d: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(d) + 1).cast("int")


def day_name_fr(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in DAY_NAMES_FR]), iso_weekday(d))


def month_name_fr(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_NAMES_FR]), F.month(d))


def calendar_columns(d: Column) -> dict[str, Column]:
    """All attributes of one calendar day (fiscal year = calendar year)."""
    return {
        "date_key": date_key(d),
        "date_complete": d,
        "annee": F.year(d).cast("int"),
        "mois": F.month(d).cast("int"),
        "jour": F.dayofmonth(d).cast("int"),
        "trimestre": F.quarter(d).cast("int"),
        "semaine": F.weekofyear(d).cast("int"),
        "jour_semaine": iso_weekday(d),
        "nom_jour": day_name_fr(d),
        "nom_mois": month_name_fr(d),
        "est_weekend": F.weekday(d) >= 5,
        "est_jour_ferie": F.lit(False),
        "annee_fiscale": F.year(d).cast("int"),
        "trimestre_fiscal": F.quarter(d).cast("int"),
    }
