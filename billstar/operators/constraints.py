"""Table constraints as data-quality operators.

Spark file tables do not enforce NOT NULL / CHECK / UNIQUE / FOREIGN KEY,
so each is an operator returning the violating rows. All row rules of a
table are evaluated in a single pass (an array of violated rule names per
row, exploded), so checking ten rules costs one scan, not ten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstar.config import STAGING_LENGTHS

STAGING_NOT_NULL = ("patient_id", "etablissement_id", "date_facturation", "montant_facture")
FACT_NOT_NULL = ("patient_key", "etablissement_key", "date_key", "montant_facture", "montant_paye", "montant_impaye")


def not_null_rules(columns) -> dict[str, Column]:
    return {f"not_null_{c}": F.col(c).isNull() for c in columns}


def amount_rules() -> dict[str, Column]:
    """CHECK (x >= 0): a NULL passes, as in SQL."""
    return {
        "check_montant_facture_positive": F.col("montant_facture") < 0,
        "check_montant_paye_positive": F.col("montant_paye") < 0,
    }


def date_rules() -> dict[str, Column]:
    return {"check_dates_coherentes": F.col("date_paiement").isNotNull()
            & (F.col("date_paiement") < F.col("date_facturation"))}


def balance_rules() -> dict[str, Column]:
    return {"check_coherence_montants": F.col("montant_impaye")
            != (F.col("montant_facture") - F.col("montant_paye"))}


def length_rules(limits: dict[str, int] = STAGING_LENGTHS) -> dict[str, Column]:
    return {f"length_{c}": F.length(F.col(c)) > n for c, n in limits.items()}


def fact_rules() -> dict[str, Column]:
    """Every constraint of the fact table: NOT NULL, the two CHECKs on
    amounts and the balance CHECK (its foreign keys hold by construction:
    the fact is built with inner lookups)."""
    return {**not_null_rules(FACT_NOT_NULL), **amount_rules(), **balance_rules()}


def broken_rules(rules: dict[str, Column]) -> Column:
    """Array of the names of the rules a row breaks (empty when none)."""
    return F.filter(
        F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]),
        lambda x: x.isNotNull())


class ConstraintError(ValueError):
    """Rows of a batch break a table constraint (strict mode)."""


def violations(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """(rule, key) for every row and rule it breaks; one pass."""
    flagged = broken_rules(rules)
    return (df.select(F.col(key).alias(key), flagged.alias("_rules"))
            .where(F.size("_rules") > 0)
            .select(F.explode("_rules").alias("rule"), key))


def duplicate_keys(df: DataFrame, key: str, table: str) -> DataFrame:
    """UNIQUE / PRIMARY KEY: keys present more than once."""
    return (df.groupBy(F.col(key).cast("string").alias("key_value")).count()
            .where(F.col("count") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "key_value",
                    F.col("count").alias("occurrences")))


def fk_orphans(fact: DataFrame, dims) -> DataFrame:
    """(constraint_name, fact_id, missing_key) of fact rows whose foreign
    key has no dimension row (a NULL service key is allowed). One pass over
    the fact: key-only dimensions are left-joined, the broken keys of a row
    gathered in an array and exploded."""
    pairs = [("patient_key", dims.patient), ("etablissement_key", dims.etablissement),
             ("date_key", dims.date), ("service_key", dims.service)]
    rows = fact.select("fact_id", *[k for k, _ in pairs])
    for k, dim in pairs:
        rows = rows.join(dim.select(k, F.lit(True).alias(f"_has_{k}")), k, "left")
    broken = F.filter(
        F.array(*[F.when(F.col(k).isNotNull() & F.col(f"_has_{k}").isNull(),
                         F.struct(F.lit(f"fk_fact_{k}").alias("constraint_name"), F.col(k).alias("missing_key")))
                  for k, _ in pairs]),
        lambda x: x.isNotNull())
    return (rows.select("fact_id", F.explode(broken).alias("b"))
            .select("b.constraint_name", "fact_id", "b.missing_key"))
