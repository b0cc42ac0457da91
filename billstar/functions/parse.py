"""Lenient parsing of raw string fields (all JVM-side expressions).

Raw fields are read as strings; typed values come only from ``try_*``
functions, so a bad value becomes NULL instead of failing the job (ANSI
mode stays on for everything else).

Each rule is written once as Spark SQL text over an input expression
(``*_sql``), so a whole standardising projection is one ``selectExpr``:
one driver call per projection instead of several per column. The
``Column`` forms wrap the same text for a named column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billstar.config import NULL_TOKENS


def sql_string(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A quoted column identifier."""
    return "`" + name.replace("`", "``") + "`"


_TOKENS = ", ".join(sql_string(t) for t in NULL_TOKENS)


def null_tokens_to_null_sql(e: str) -> str:
    """The reader's missing-value tokens (compared after trimming) -> NULL;
    other values are kept as they are."""
    return f"CASE WHEN trim({e}) IN ({_TOKENS}) THEN NULL ELSE {e} END"


def lenient_timestamp_sql(e: str, formats: tuple[str, ...]) -> str:
    """First format that parses wins; unparsable or impossible dates -> NULL."""
    s = f"trim({null_tokens_to_null_sql(e)})"
    return "coalesce(" + ", ".join(f"try_to_timestamp({s}, {sql_string(f)})" for f in formats) + ")"


def lenient_decimal_sql(e: str, precision: int = 12, scale: int = 2) -> str:
    """Number or NULL; NaN/inf/overflow -> NULL."""
    return f"try_cast(trim({null_tokens_to_null_sql(e)}) AS decimal({precision},{scale}))"


def lenient_count_sql(e: str, default: int = 1) -> str:
    """Integer count: decimals truncated, unparsable or missing -> default."""
    return f"coalesce(try_cast(try_cast(trim({null_tokens_to_null_sql(e)}) AS double) AS int), {int(default)})"


def null_tokens_to_null(name: str) -> Column:
    return F.expr(null_tokens_to_null_sql(ident(name)))


def lenient_timestamp(name: str, formats: tuple[str, ...]) -> Column:
    return F.expr(lenient_timestamp_sql(ident(name), formats))


def lenient_decimal(name: str, precision: int = 12, scale: int = 2) -> Column:
    return F.expr(lenient_decimal_sql(ident(name), precision, scale))


def lenient_count(name: str, default: int = 1) -> Column:
    return F.expr(lenient_count_sql(ident(name), default))
