"""URL filtering by an index of pattern rules, in DataFrame functions only.

Each rule is filed under its rarest literal token, rarity being counted
over the judged URLs. A URL's tokens fetch the rules filed under them, and
only those run their regular expression. Among a URL's matching host and
path rules the longest wins; URLs without one get the verdict of the
method's own pattern rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to which the index is broadcast; beyond it the join shuffles.
BROADCAST_RULES = 50_000

#: Host words of the method's own rules; a URL whose host has one as a
#: whole word, set off by dots or hyphens, is blocked.
METHOD_WORDS = ("adult", "ads", "bets", "betting", "casino", "escort", "gambling", "pills", "poker",
                "porn", "spam", "viagra", "xxx")


def host_path_rule(rule: str, verdict: str) -> tuple:
    """A ``host/path`` rule. It fits the host and its subdomains where the
    URL's path starts with the rule's. Its literals are the tokens that any URL it
    fits has whole: the path's last one may go on in a URL, unless a
    delimiter ends it."""
    host, slash, path = rule.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    whole = re.findall(r"[^\W_]+", host)
    whole += re.findall(r"[^\W_]+(?=[\W_])", slash + path)
    regex = f"^(?:[^/]*\\.)?{_quote(host)}(?=/|$){_quote(slash + path)}"
    return rule, verdict, regex, whole, 1


def word_rule(word: str) -> tuple:
    """A rule of the method: the host has the word, before a dot, a hyphen,
    a port or its end."""
    ends = "(?=[.-]|(?::[0-9]*)?(?:/|$))"
    return f"host word {word}", "block", f"^(?:[^/]*[.-])?{_quote(word)}{ends}", [word], 0


def _quote(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", text)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as a table (rule, verdict, regex, literals, rank): (rule text,
    verdict) pairs by host and path, rank 1, and the method's, rank 0. A
    rule without literals is filed under '', which every URL fetches.
    ``judge`` takes any table of these columns, so long lists can be read from files."""
    rows = [host_path_rule(r, v) for r, v in rules] + [word_rule(w) for w in METHOD_WORDS]
    literal = [
        F.struct(
            F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(regex).alias("regex"),
            F.array(*map(F.lit, literals)).cast("array<string>").alias("literals"), F.lit(rank).alias("rank"))
        for rule, verdict, regex, literals, rank in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literal)))


def split_url(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, host, path): the host after the first ``://`` with A-Z
    lower-cased, and the path up to ``?``, ``#`` or the end; both empty for
    a NULL url or one without ``://``."""
    rest = "substring(url, instr(url, '://') + 3)"
    has = "coalesce(instr(url, '://') > 0, false)"
    return pages.selectExpr(
        id_col,
        f"if({has}, translate(regexp_extract({rest}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}'), '') as host",
        f"if({has}, regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') as path",
    )


def index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with the token it is filed under: the one of its literals
    that the fewest URLs have; ties go to the first by code point.
    ``tokens`` has a row for each URL and distinct token."""
    literals = rules.select("rule", F.explode("literals").alias("token"))
    wanted = literals.select("token").distinct()
    seen = tokens.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_RULES else wanted, "token")
    counts = seen.groupBy("token").agg(F.count("*").alias("urls"))
    rarest = literals.join(counts, "token", "left").groupBy("rule").agg(
        F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("token"))
    return rules.join(rarest, "rule", "left").select(
        "rule", "verdict", "regex", "rank", F.coalesce("token", F.lit("")).alias("token"))


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per page row: id, host, path, rule, verdict, method_rule.

    Distinct targets are judged once, so a URL that repeats many times
    costs one look-up. ``rule`` and the verdict come from the longest
    fitting host and path rule (ties: the first by code point); without
    one, rule is NULL and the verdict block if a method rule fits (it is
    then named in method_rule), else allow. NULL and malformed urls have
    empty host and path and are allowed; other columns are not read.
    """
    rows = split_url(pages, id_col).withColumn("target", F.concat("host", "path"))
    targets = rows.select("target").distinct()
    tokens = targets.select("target", F.explode(F.array_distinct(F.concat(
        F.array(F.lit("")), F.regexp_extract_all("target", F.lit(TOKEN), F.lit(0))))).alias("token"))
    filed = index(rules, tokens)
    fetched = tokens.join(F.broadcast(filed) if rules.count() <= BROADCAST_RULES else filed, "token")
    best = fetched.where("regexp_like(target, regex)").groupBy("target").agg(
        F.min_by(
            F.struct("rule", "verdict", "rank"), F.struct(-F.col("rank"), -F.length("rule"), "rule")
        ).alias("best"))
    out = rows.join(best, "target", "left")
    return out.select(
        id_col, "host", "path",
        F.expr("if(best.rank = 1, best.rule, null)").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
        F.expr("if(best.rank = 0, best.rule, null)").alias("method_rule"),
    )


def oracle(rules: list[tuple[str, str]]) -> str:
    """The same verdicts in DuckDB SQL over a view pages, trying every rule."""
    listed = ", ".join(
        f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in rules)
    words = ", ".join(f"'{w}'" for w in sorted(METHOD_WORDS, key=lambda w: (-len(w), w)))
    return rf"""
        WITH p AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest
            FROM pages),
        u AS (
            SELECT row_number() OVER () AS n, page_id,
                   translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM p),
        r(rule, rhost, rpath, verdict) AS (VALUES {listed}),
        hit AS (
            SELECT n, max_by(r, length(rule)) AS best FROM u JOIN r
            ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
        SELECT page_id, host, path, best.rule AS rule,
               coalesce(best.verdict, CASE WHEN m IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
               CASE WHEN best IS NULL THEN 'host word ' || m END AS method_rule
        FROM (SELECT *, list_filter([{words}], lambda w: regexp_matches(
                      host || path, '^([^/]*[.-])?' || w || '([.-]|(:[0-9]*)?(/|$))'))[1] AS m FROM u)
             LEFT JOIN hit USING (n)"""
