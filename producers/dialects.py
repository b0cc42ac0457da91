"""Write silver-shaped rows as producer files (the five dialects).

Used to turn the driver tables into real raw inputs, so the file readers
and standardiser run on whole tables. CSV files come from Spark's CSV
writer (one file per task, header in each) and are then renamed to the
producer's naming; spreadsheets are written inside tasks, one per partition,
row by row as Spark hands the rows over: no task holds a workbook or its rows.
"""

from __future__ import annotations

from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.config import COLUMN_MAPS, DIALECTS, SOURCE5_ORDER
from billstar.sources import fs

DATE_COLS = ("date_facturation", "date_paiement")
NUMBER_COLS = ("montant_facture", "montant_paye", "nombre_lignes")


def source_columns(key: str) -> list[str]:
    """Source column names in the order the producer writes them."""
    if key == "etablissement5":
        return list(SOURCE5_ORDER)
    return list(COLUMN_MAPS[key])


def _formatted(rows: DataFrame, key: str) -> DataFrame:
    _, _, _, pattern = DIALECTS[key]
    inverse = {canon: src for src, canon in COLUMN_MAPS[key].items()}
    cols = []
    for src in source_columns(key):
        canon = COLUMN_MAPS[key][src]
        c = F.col(canon)
        if canon in DATE_COLS:
            c = F.date_format(c, pattern)
        cols.append(c.cast("string").alias(inverse[canon]))
    return rows.select(*cols)


def export_csv(spark: SparkSession, rows: DataFrame, key: str, out_dir: str) -> list[str]:
    name, fmt, sep, _ = DIALECTS[key]
    assert fmt == "csv"
    stem = name.rsplit(".", 1)[0]
    tmp = f"{out_dir.rstrip('/')}/_w_{stem}"
    (_formatted(rows, key).write.mode("overwrite")
     .option("header", True).option("sep", sep).option("encoding", "UTF-8").option("escape", '"')
     .csv(tmp))
    out = []
    for i, part in enumerate(fs.list_files(spark, tmp, ".csv")):
        dst = f"{out_dir.rstrip('/')}/{stem}-{i:05d}.csv"
        fs.rename(spark, part, dst)
        out.append(dst)
    return out


def export_xlsx(spark: SparkSession, rows: DataFrame, key: str, out_dir: str) -> list[str]:
    name, fmt, _, _ = DIALECTS[key]
    assert fmt == "xlsx"
    stem = name.rsplit(".", 1)[0]
    header = source_columns(key)
    canon = [COLUMN_MAPS[key][s] for s in header]
    date_src = {s for s in header if COLUMN_MAPS[key][s] in DATE_COLS}
    num_src = {s for s in header if COLUMN_MAPS[key][s] in NUMBER_COLS}
    target = out_dir.rstrip("/")

    def records(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                rec = []
                for v in r:
                    if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
                        rec.append(None)
                    elif isinstance(v, pd.Timestamp):
                        rec.append(v.to_pydatetime())
                    else:
                        rec.append(v)
                yield rec

    def write(batches):
        from pyspark import TaskContext

        from producers.workbook import stream_workbook
        recs = records(batches)
        first = next(recs, None)
        if first is None:
            return
        path = f"{target}/{stem}-{TaskContext.get().partitionId():05d}.xlsx"
        with fs.open_output(path) as out:
            n = stream_workbook(out, header, chain([first], recs), date_src, num_src)
        yield pd.DataFrame({"path": [path], "rows": [n]})

    src = rows.select(*[F.col(c).alias(s) for c, s in zip(canon, header)])
    for s in num_src:
        src = src.withColumn(s, F.col(s).cast("string"))
    written = src.mapInPandas(write, T.StructType([
        T.StructField("path", T.StringType()), T.StructField("rows", T.LongType())])).collect()
    return sorted(r.path for r in written)


def export(spark: SparkSession, rows: DataFrame, key: str, out_dir: str) -> list[str]:
    if DIALECTS[key][1] == "xlsx":
        return export_xlsx(spark, rows, key, out_dir)
    return export_csv(spark, rows, key, out_dir)


def export_by_region(spark: SparkSession, rows: DataFrame, region_of: DataFrame, out_dir: str) -> list[str]:
    """Spread rows over the five producers by facility region (region r ->
    producer r+1); every row lands in exactly one file."""
    keyed = rows.join(region_of, "etablissement_id", "left")
    keys = sorted(COLUMN_MAPS)
    out = []
    for r, key in enumerate(keys):
        cond = (F.col("region_key") == r) if r < len(keys) - 1 else (
            (F.col("region_key") >= r) | F.col("region_key").isNull())
        out += export(spark, keyed.where(cond).drop("region_key"), key, out_dir)
    return out
