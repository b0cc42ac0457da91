"""Quoted files in splits: the same records as a reader that takes the file
whole, from any split size; many tasks for one file; thousands of files
without a driver row for each."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from billstar.operators.standardize import build_silver, read_and_standardize
from billstar.sources import files, splits
from tests.conftest import write_text
from tests.test_sources import RUN_TS, SRC1, SRC2

HEADER = SRC1.split("\n", 1)[0]


def some_text(seed: int, end: str, n: int = 60) -> str:
    rng = random.Random(seed)
    field = lambda: rng.choice(
        ["a", "bb", "", 'say "x"', "two\nlines", "comma, here", '"', '""', "é\r\nü", "end\n", '\n"', " q "])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow(["h1", "h\n2", "h3"])
    for _ in range(n):
        writer.writerow([field(), field(), field() or "z"])
    return out.getvalue()


def read_by(path: str, size: int, sep: str = ",") -> list[bytes]:
    """All records, split by split, states composed one after the other."""
    out, state, total = [], splits.OUTSIDE, os.path.getsize(path)
    for start in range(0, total, size):
        length = min(size, total - start)
        out += splits.records(path, start, length, state, sep)
        data, before = splits._range(path, start, length)
        state = splits.quoted_spans(data, state, before, sep)[2]
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_any_split_size_gives_the_same_records(workdir, seed, end):
    text = some_text(seed, end)
    path = os.path.join(workdir, "x.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    want = [r for r in csv.reader(io.StringIO(text, newline="")) if any(x.strip() for x in r)][1:]
    for size in (1, 2, 3, 7, 64, 1000, 10**6):
        got = [next(csv.reader(io.StringIO(r.decode(), newline=""))) for r in read_by(path, size)]
        assert got == want, size


def test_stray_quotes_and_no_last_line_end(workdir):
    path = write_text(os.path.join(workdir, "x.csv"), 'h,i\n5" pipe,a\n"b\nc","d"\n6" x"y,"e"f\n\n\nlast,"q\nr"')
    want = [b'5" pipe,a', b'"b\nc","d"', b'6" x"y,"e"f', b'last,"q\nr"']
    for size in (1, 2, 3, 4, 5, 8, 100):
        assert read_by(path, size) == want, size


def test_a_record_longer_than_many_splits(workdir, monkeypatch):
    monkeypatch.setattr(splits, "MORE", 16)
    long = '"' + "x\n" * 5000 + '"'
    path = write_text(os.path.join(workdir, "x.csv"), f"﻿h\n1\n{long}\n2\n")
    assert read_by(path, 100) == [b"1", long.encode(), b"2"]


def test_one_file_is_read_by_many_tasks(spark, workdir, monkeypatch):
    rows = "".join(f'P{i},"Du\nPont {i}",Jean,ETAB001,"Clinique, 1",URGENCES,05/01/2025,{i}.50,PAYE,0,,1\n'
                   for i in range(4000))
    write_text(os.path.join(workdir, "etablissement1_x.csv"), f"{HEADER}\n{rows}P-short,1\n")
    copies = files.lay_out(files.manifest(spark, workdir), f"{workdir}/bronze")
    [x] = files.layouts(copies)
    assert (x.kind, x.files) == ("spans", 1)
    own = copies.select(F.col("bronze_path").alias("path"), "bytes")
    raw = splits.read_spanning(spark, own, ",", files.record_schema(x.fields), files.CORRUPT, size=20_000)
    by_task = raw.where("_corrupt_record is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(by_task) >= 6 and sum(r["count"] for r in by_task) == 4000
    monkeypatch.setattr(splits.read_spanning, "__defaults__", (20_000,))
    good, bad = read_and_standardize(spark, copies, RUN_TS)
    assert [r.first_field for r in bad.collect()] == ["P-short"]
    got = {r.patient_id: (r.patient_nom, str(r.montant_facture), r.source_file) for r in good.collect()}
    assert got == {f"P{i}": (f"Du\nPont {i}", f"{i}.50", "etablissement1_x.csv") for i in range(4000)}


def test_thousands_of_files_are_a_few_layouts(spark, workdir, monkeypatch):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    one, two = SRC1.split("\n")[1], SRC2.split("\n")
    for i in range(1000):
        write_text(os.path.join(src, f"etablissement1_{i}.csv"), f"{HEADER}\n{one}\n")
        write_text(os.path.join(src, f"etablissement2_{i}.csv"), f"{two[0]}\n{two[1]}\n")
    largest, collect = [], type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda df: largest.append(len(rows := collect(df))) or rows)
    silver = build_silver(spark, files.manifest(spark, src), RUN_TS)
    assert largest and max(largest) <= 2
    assert silver.count() == 2000
