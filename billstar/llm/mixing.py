"""Weighted fair queueing of sources, in DataFrame functions only.

Documents are shuffled by a hash of their id. A document's virtual finish
time is the words its source has used up to and including it, divided by
the source's target; a document may be sent PASSES times, the later passes
queueing behind a whole source. All (document, pass) pairs are ordered by
finish time and truncated at the total budget, at which every source has
been served its share.

No queue is walked in one task: a source's running sums come from
sums per hash bucket, and the place of the cut from sums per bin of finish time;
only the rows of the last, narrow bin are ordered together. Rows of one id
and size are one row with a count until each gets its own finish time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billstar.llm.common import WORD, discard, written

#: Hex digits of the hash that name a bucket: 16**3 of them for each source.
BUCKET_DIGITS = 3
#: Bins of a unit of finish time in the two searches for the cut.
BINS = (1 << 12, 1 << 24)
#: Repeats of a row that are counted off together.
REPEATS = 4096
#: Stands for a NULL id in orderings, where NULL sorts first.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    passes: int = 2


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, size, sk, key): words of the text (0 for NULL), the source
    as a key that is never NULL and sorts as sources do with NULL last, and
    the shuffling hash of the id (of the text where the id is NULL)."""
    return documents.select(*[c.alias(n) for n, c in _measured().items()])


def _measured() -> dict[str, Column]:
    return {
        "doc_id": F.col("doc_id"),
        "size": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"),
        "sk": F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("b")),
        "key": F.coalesce(F.md5(F.col("doc_id").cast("string")), F.md5("text"), F.lit("")),
    }


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(sk, source_size, target) from (sk, source_size).

    Sources share ``share`` of all words by weight, none above ``passes``
    times its size. With r = cap / weight, the sources of lowest r are the
    capped ones: going up in r, one is capped while its r is within what
    the words left give a unit of weight. The windows hold one row per source.
    """
    weight = "case (row_number() over (order by sk) - 1) % {n} {arms} end".format(
        n=len(mix.weights),
        arms=" ".join(f"when {i} then {w}" for i, w in enumerate(mix.weights)))
    s = sizes.selectExpr("sk", "source_size", f"{weight} as weight")
    s = s.selectExpr(
        "*", f"{mix.share}D * sum(source_size) over () as budget", f"{mix.passes} * source_size as cap")
    s = s.selectExpr(
        "*",
        """budget - coalesce(sum(cap) over (order by cap / weight, sk
               rows between unbounded preceding and 1 preceding), 0) as left_over""",
        """sum(weight) over (order by cap / weight, sk
               rows between current row and unbounded following) as weights""")
    s = s.selectExpr("*", "cap * weights <= left_over * weight as capped")
    return s.selectExpr(
        "sk", "source_size",
        """case when capped then cast(cap as double)
           else (budget - sum(if(capped, cap, 0)) over ()) * weight / sum(if(capped, 0, weight)) over ()
           end as target""")


def _cut(rows: DataFrame, budget: float) -> tuple[int, float]:
    """The bin in which the running sum of ``size`` passes the budget, and
    the sum before it. Only this pair reaches the driver."""
    bins = rows.groupBy("bin").agg(F.sum("size").alias("size"))
    upto = bins.select("bin", "size", F.sum("size").over(Window.orderBy("bin")).alias("upto"))
    first = upto.where(F.col("upto") > budget).orderBy("bin").first()
    return (first.bin, first.upto - first["size"]) if first else (None, 0)


def plan(spark: SparkSession, documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document row: doc_id, size, sk, key, source_size,
    target, ahead (the source's words before the document's first copy),
    copy (from 1, among rows of one id, size and source), used (the source's
    words up to the row), passes (how often it is taken) and taken (words
    the mix takes, repeats counted).

    Rows of one id, size and source queue one behind the other, so each
    has a finish time of its own; which of them is which copy makes no
    difference to the plan, and reruns agree. Words of a source differ
    from its target by less than its next document. Documents without
    words are never taken; other columns are not read.
    """
    rows = sized(documents).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    rows = written(spark, rows.groupBy("sk", "bucket", "key", "size", "doc_id").agg(F.count("*").alias("n")), "sizes")
    parts = rows.groupBy("sk", "bucket").agg(F.sum(F.expr("size * n")).alias("part"))
    parts = written(spark, parts, "parts")
    goal = targets(parts.groupBy("sk").agg(F.sum("part").alias("source_size")), mix)
    goal = written(spark, goal, "targets")
    budget = goal.agg(F.sum("target").alias("t")).first().t or 0.0

    upto = Window.partitionBy("sk").orderBy("bucket")
    before_part = parts.select("sk", "bucket", (F.sum("part").over(upto) - F.col("part")).alias("before"))
    earlier = Window.partitionBy("sk", "bucket").orderBy("key", "size", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    queued = rows.join(before_part.join(goal, "sk"), ["sk", "bucket"]).withColumn(
        "ahead", F.col("before") + F.coalesce(F.sum(F.expr("size * n")).over(earlier), F.lit(0)))
    # a row's repeats in blocks, the blocks dealt over tasks
    queued = queued.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {REPEATS})"))).repartition(
        "sk", "key", "block")
    queued = written(spark, queued.drop("before", "bucket"), "queued")
    discard(rows, parts, goal)
    queued = queued.withColumn("copy", F.explode(F.expr(
        f"sequence(block * {REPEATS} + 1, least(n, (block + 1) * {REPEATS}))")))
    queued = queued.withColumn("used", F.expr("ahead + copy * size"))
    sent = queued.where("size > 0").select(
        "sk", "key", "doc_id", "size", F.explode(F.sequence(F.lit(0), F.lit(mix.passes - 1))).alias("pass"),
        "source_size", "target", "used",
    ).selectExpr(
        "key", "doc_id", "size", "pass", "sk", "(pass * source_size + used) / target as finish"
    ).where("finish is not null")

    # the cut: bin by bin, then row by row in the last bin
    last = sent.withColumn("bin", F.floor(F.col("finish") * BINS[0]))
    before, left = [], budget
    for k, scale in enumerate(BINS):
        at, under = _cut(last, left)
        if at is None:
            break
        before.append((scale, at))
        left -= under
        last = last.where(F.col("bin") == at)
        if k + 1 < len(BINS):
            last = last.withColumn("bin", F.floor(F.col("finish") * BINS[k + 1]))
    last = last.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    mark = ["finish", "pass", "key", "size", "sk", "id"]
    fits = last.select(
        *mark, F.sum("size").over(Window.orderBy(*mark)).alias("upto")
    ).where(F.col("upto") <= left).orderBy(*[F.col(c).desc() for c in mark]).first() if before else None

    def taken(p: int) -> Column:
        """Pass p of a queued row lies before the cut."""
        finish = (F.lit(p) * F.col("source_size") + F.col("used")) / F.col("target")
        if not before:
            return F.lit(True)
        inside, same = F.lit(False), F.lit(True)
        for scale, at in before:
            at_bin = F.floor(finish * scale)
            inside, same = inside | (same & (at_bin < at)), same & (at_bin == at)
        if fits:
            own = F.struct(
                finish.alias("finish"), F.lit(p).alias("pass"), "key", "size", "sk",
                F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"))
            end = F.struct(
                F.lit(fits["finish"]).alias("finish"), F.lit(fits["pass"]).alias("pass"),
                F.lit(fits["key"]).alias("key"), F.lit(fits["size"]).cast("long").alias("size"),
                F.lit(fits["sk"]).alias("sk"), F.lit(fits["id"]).cast("long").alias("id"))
            inside = inside | (same & (own <= end))
        return F.coalesce(inside, F.lit(False))

    passes = reduce(add, [taken(p).cast("int") for p in range(mix.passes)])
    return queued.withColumn("passes", F.when(F.col("size") > 0, passes).otherwise(0)).selectExpr(
        "doc_id", "size", "sk", "key", "source_size", "target", "ahead", "copy", "used", "passes",
        "size * passes as taken")


def mixed(spark: SparkSession, documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: a row for each (document, pass) taken, with the
    columns of ``documents`` and mix_pass and mix_finish (in place of
    columns of these names), range-sorted by finish time.

    Equal rows are one with a count. Of the rows of one id, size and
    source, the copies of the plan go to them in the order of their hash.
    """
    documents = documents.drop("mix_pass", "mix_finish")
    groups = plan(spark, documents, mix).where("passes > 0").groupBy(
        F.col("doc_id").alias("i"), F.col("size").alias("n"), F.col("sk").alias("s"), F.col("key").alias("k"),
        "source_size", "target", "ahead",
    ).agg(F.array(*[F.count_if(F.col("passes") > p) for p in range(mix.passes)]).alias("copies"))
    groups = written(spark, groups, "plan")
    own = {f"d_{n}": c for n, c in _measured().items()}
    measured = documents.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in own.items()]).groupBy(
        "row", *own).agg(F.count("*").alias("count")).withColumn("h", F.xxhash64("row"))
    # where each distinct row's copies begin: without texts, as few rows of an id differ
    keys = ["d_key", "d_size", "d_sk", "d_doc_id"]
    first = Window.partitionBy(*keys).orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    begin = measured.groupBy(*keys, "h").agg(F.sum("count").alias("same")).withColumn(
        "begin", F.coalesce(F.sum("same").over(first), F.lit(0)))
    begin = written(spark, begin.join(groups, F.expr("d_key = k and d_size = n and d_sk = s and d_doc_id <=> i")).select(
        F.col("d_key").alias("k"), F.col("d_size").alias("n"), F.col("d_sk").alias("s"), F.col("d_doc_id").alias("i"),
        F.col("h").alias("g"), "same", "begin", "source_size", "target", "ahead", "copies"), "begin")
    met = measured.join(begin, F.expr("h = g and d_key = k and d_size = n and d_sk = s and d_doc_id <=> i")).select(
        "row", "k", "n", "begin", "source_size", "target", "ahead", F.least("count", "same").alias("same"),
        F.posexplode("copies").alias("pass", "upto"))
    met = met.withColumn("take", F.expr("least(greatest(upto - begin, 0), same)")).where("take > 0")
    met = met.withColumn("block", F.explode(F.expr(f"sequence(0L, (take - 1) div {REPEATS})"))).withColumn(
        "copy", F.explode(F.expr(
            f"sequence(begin + block * {REPEATS} + 1, begin + least(take, (block + 1) * {REPEATS}))")))
    sent = met.selectExpr("row", "k", "copy", "pass", "(pass * source_size + ahead + copy * n) / target as finish")
    sent = sent.orderBy("finish", "pass", "k", "copy")
    return sent.select("row.*", F.col("pass").alias("mix_pass"), F.col("finish").alias("mix_finish"))


def oracle(mix: Mix = Mix()) -> str:
    """The same plan in DuckDB SQL over a view documents, row by row in
    windows instead of by counts, buckets and bins."""
    arms = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mix.weights))
    return rf"""
        WITH d AS (
            SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   source, coalesce(md5(doc_id::VARCHAR), md5(text), '') AS key
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} {arms} END AS weight
            FROM d GROUP BY source),
        capped AS (
            SELECT *, {mix.passes} * source_size AS cap, {mix.share} * sum(source_size) OVER () AS budget FROM s),
        asked AS (
            SELECT *, cap * sum(weight) OVER (
                       ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                   <= (budget - coalesce(sum(cap) OVER (
                       ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                      ) * weight AS is_capped
            FROM capped),
        goal AS (
            SELECT source, source_size, budget, CASE WHEN is_capped THEN cap::DOUBLE ELSE
                (budget - sum(CASE WHEN is_capped THEN cap ELSE 0 END) OVER ())::DOUBLE * weight
                / sum(CASE WHEN is_capped THEN 0 ELSE weight END) OVER () END AS target
            FROM asked),
        queued AS (
            SELECT d.*, source_size, target, sum(size) OVER (
                PARTITION BY d.source ORDER BY key, size, doc_id ROWS UNBOUNDED PRECEDING) AS used
            FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source),
        sent AS (
            SELECT *, unnest(range(0, {mix.passes})) AS pass FROM queued WHERE size > 0),
        ordered AS (
            SELECT *, sum(size) OVER (ORDER BY (pass * source_size + used)::DOUBLE / target, pass, key, size,
                                      source NULLS LAST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto
            FROM sent),
        taken AS (
            SELECT source, used, count(*) AS n
            FROM ordered WHERE upto <= (SELECT sum(target) FROM goal) GROUP BY ALL)
        SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(q.size * t.n, 0)::BIGINT AS taken
        FROM queued q LEFT JOIN taken t
             ON q.size > 0 AND q.used = t.used AND q.source IS NOT DISTINCT FROM t.source"""
