"""The spreadsheet producer: whole rows, in memory that does not grow with a workbook."""

from __future__ import annotations

import datetime as dt
import io
import tracemalloc
from types import SimpleNamespace

import pandas as pd
import pyspark
from pyspark.sql import functions as F

from billstar.sources import files, fs
from billstar.sources.xlsx import read_rows
from producers import dialects
from producers.workbook import stream_workbook, write_workbook

KEY = "etablissement4"


def test_a_task_holds_neither_the_workbook_nor_its_rows(spark, workdir, monkeypatch):
    """The function that export_xlsx hands to Spark, given 100 batches."""
    n, size = 100, 300
    header = dialects.source_columns(KEY)
    dates = [h for h in header if dialects.COLUMN_MAPS[KEY][h] in dialects.DATE_COLS]

    def batches():
        for b in range(n):
            yield pd.DataFrame({h: [pd.Timestamp(2020, 1, 1 + b % 28)] * size if h in dates
                                else [f"{b * size + i}" for i in range(size)] for h in header})

    class Rows:
        def select(self, *columns):
            return self

        def withColumn(self, name, column):
            return self

        def mapInPandas(self, write, schema):
            return SimpleNamespace(collect=lambda: [
                SimpleNamespace(**r) for made in write(batches()) for r in made.to_dict("records")])

    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: SimpleNamespace(partitionId=lambda: 7)))
    tracemalloc.start()
    paths = dialects.export_xlsx(spark, Rows(), KEY, workdir)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(paths) == 1 and paths[0].endswith("-00007.xlsx")
    with fs.open_seekable(paths[0]) as book:
        found, rows = read_rows(book, set(dates))
        rows = list(rows)
    assert found == header and len(rows) == n * size
    text = next(i for i, h in enumerate(header) if h not in dates)
    assert [int(r[text]) for r in rows] == list(range(n * size))
    assert {r[header.index(dates[0])] for r in rows} == {f"2020-01-{d:02d} 00:00:00" for d in range(1, 29)}
    assert peak < 8 << 20


def test_export_keeps_every_row_across_batches_and_empty_tasks(spark, workdir):
    silver = ["patient_id", "patient_nom", "patient_prenom", "etablissement_id", "etablissement_nom", "service",
              "date_facturation", "montant_facture", "statut_paiement", "montant_paye", "date_paiement",
              "nombre_lignes"]
    rows = spark.range(0, 1_000, 1, 4).where("id < 200 or id >= 500").selectExpr(
        "if(id % 7 = 0, null, cast(id as string)) as patient_id", "concat('<&', id, '>') as patient_nom",
        "cast(null as string) as patient_prenom", "'E1' as etablissement_id", "'é' as etablissement_nom",
        "if(id < 700, null, 'S') as service",
        "if(id % 5 = 0, null, timestamp '2024-02-29 06:30:00' + make_interval(0, 0, 0, id)) as date_facturation",
        "cast(id / 4 as decimal(12,2)) as montant_facture", "'F' as statut_paiement",
        "cast(null as decimal(12,2)) as montant_paye", "cast(null as timestamp) as date_paiement",
        "cast(if(id % 3 = 0, null, id) as int) as nombre_lignes")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        paths = dialects.export(spark, rows, KEY, workdir)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(paths) == 3          # one of the four tasks has no row
    (spec, read), = files.read_sources(spark, files.manifest(spark, workdir))
    back = read.select(*[F.col(source).alias(name) for source, name in spec.column_map.items()]).select(silver)
    want = rows.select(*[F.col(c).cast("string") for c in silver])
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))


def test_a_stream_that_cannot_seek_gets_the_same_rows():
    class Pipe(io.RawIOBase):
        def __init__(self):
            self.data = bytearray()

        def writable(self):
            return True

        def write(self, b):
            self.data += b
            return len(b)

    header, rows = ["A", "B", "C"], [["x", None, "2"], [None, dt.datetime(2024, 5, 1, 12), None]]
    pipe = Pipe()
    assert stream_workbook(pipe, header, iter(rows), {"B"}, {"C"}) == 2
    for book in (bytes(pipe.data), write_workbook(header, rows, {"B"}, {"C"})):
        found, back = read_rows(book, {"B"})
        assert found == header and [r + [None] * (3 - len(r)) for r in back] == [
            ["x", None, "2"], [None, "2024-05-01 12:00:00", None]]
    pipe = Pipe()
    assert stream_workbook(pipe, header, iter([])) == 0
    assert [list(x) for x in read_rows(bytes(pipe.data))] == [header, []]
