"""Raw billing files: discovery (A1), raw copy (A2), source resolution
(A3), delimited scan with delimiter detection (A4), spreadsheet scan (A5),
provenance (A6).

Design: the raw copy reads every byte anyway, so that pass also works out
each file's layout (source, format, header record) and lays its copy in a
folder of that layout. Readers are given folders: the driver sees one row
per layout, however many files there are. Delimited files are read by
Spark's CSV source, parallel across and inside files; those in which a
quoted field goes over a line end lie apart and are read in splits of
their own (:mod:`billstar.sources.splits`); spreadsheets, which are not
splittable, are parsed one file per task.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from hashlib import sha1
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.config import COLUMN_MAPS, DELIMITERS, SourceSpec, source_specs
from billstar.schema import all_string
from billstar.session import scratch_dir
from billstar.sources import fs
from billstar.sources.splits import read_spanning

GLOB = "*.{csv,xlsx}"
#: Spreadsheet rows handed to Spark at a time.
SHEET_CHUNK = 10_000


# ---------------------------------------------------------------- discovery
def manifest(spark: SparkSession, input_dir: str) -> DataFrame:
    """(path, file_name, length, modificationTime) of every .csv/.xlsx
    directly in ``input_dir``. The content column is never selected, so
    the binary source does not read file bodies."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", GLOB)
            .load(input_dir)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    "length", "modificationTime"))


def resolve_source(file_name: Column) -> Column:
    """File name -> source key; no digit may follow the key, so that
    ``etablissement10`` never resolves to ``etablissement1``; unmatched
    names raise."""
    stem = F.lower(F.regexp_extract(file_name, r"^(.*?)(\.[^.]*)?$", 1))
    expr = None
    for key in sorted(COLUMN_MAPS, key=len, reverse=True):
        cond = stem.rlike(key + "(?![0-9])")
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr.otherwise(F.raise_error(F.concat(F.lit("no source matches file "), file_name)))


def file_format(file_name: Column) -> Column:
    return F.lower(F.regexp_extract(file_name, r"\.([^.]+)$", 1))


# ---------------------------------------------------------------- layouts
def header_fields(header: str, sep: str) -> list[str]:
    """Field names of a header record; quoted names may hold the delimiter."""
    return [h.strip() for h in next(csv.reader([header], delimiter=sep), [])]


def choose_delimiter(header: str, expected: set[str]) -> str:
    """The first delimiter whose header fields cover the source's columns;
    otherwise the one giving the most fields."""
    best, best_n = DELIMITERS[0], -1
    for d in DELIMITERS:
        fields = header_fields(header, d)
        if expected <= set(fields):
            return d
        if len(fields) > best_n:
            best, best_n = d, len(fields)
    return best


@dataclass(frozen=True)
class Layout:
    """Files of one source, format and header record, in one folder."""

    source_key: str
    fmt: str
    header: str | None
    #: lines: a line is a record; spans: some quoted field goes over a line end.
    kind: str
    folder: str
    files: int
    sample: str

    @property
    def sep(self) -> str:
        return choose_delimiter(self.header, set(COLUMN_MAPS[self.source_key]))

    @property
    def fields(self) -> list[str]:
        return header_fields(self.header, self.sep)


MANIFEST = "_manifest"
#: Bytes copied at a time.
CHUNK = 8 << 20


class LineQuotes:
    """Whether some line of a text has an odd number of quotes, by chunks."""

    def __init__(self):
        self.odd, self.carried = False, 0

    def add(self, data: bytes) -> None:
        if self.odd or not (self.carried or b'"' in data):
            return
        raw = np.frombuffer(data, dtype=np.uint8)
        quotes = np.flatnonzero(raw == 0x22)
        upto = np.searchsorted(quotes, np.flatnonzero((raw == 0x0A) | (raw == 0x0D))) + self.carried
        self.odd = bool((np.diff(upto, prepend=0) % 2).any())
        self.carried = int(len(quotes) + self.carried - (upto[-1] if len(upto) else 0))

    def any(self) -> bool:
        return self.odd or self.carried % 2 == 1


def _lay_out(path: str, source_key: str, fmt: str, target: str) -> dict:
    """Copy one file into its layout's folder. A rerun writes the same bytes to the same place."""
    name, header, quotes = path.rsplit("/", 1)[-1], None, LineQuotes()
    folder, kind = f"{source_key}-{fmt}", "lines"
    if fmt == "csv":
        header = fs.read_record(path).decode("utf-8", errors="replace").lstrip("\ufeff")
        folder += "-" + sha1(header.encode()).hexdigest()[:12]
    place = f"{target}/{folder}/{kind}/{name}"
    copied = fs.copy_file(path, place, CHUNK, quotes.add if fmt == "csv" else None)
    if quotes.any():
        kind = "spans"
        fs.move_file(place, place := f"{target}/{folder}/{kind}/{name}")
    return {"source_key": source_key, "fmt": fmt, "header": header, "kind": kind,
            "folder": f"{target}/{folder}/{kind}", "bytes": copied, "bronze_path": place}


def lay_out(files: DataFrame, target: str) -> DataFrame:
    """Verbatim copies under ``target`` of the files of a manifest (any
    DataFrame with ``path``), made by tasks, a folder for each layout. The manifest
    with source_key, fmt, header, kind, folder, bytes and bronze_path,
    which is kept beside the copies. A file that no source matches, and any
    copy error, fails the job."""
    name = F.element_at(F.split("path", "/"), -1)
    files = files.withColumns({"source_key": resolve_source(name), "fmt": file_format(name)})
    schema = T.StructType([f for f in files.schema.fields if f.name not in ("source_key", "fmt")] + [
        T.StructField(c, T.LongType() if c == "bytes" else T.StringType())
        for c in ("source_key", "fmt", "header", "kind", "folder", "bytes", "bronze_path")])
    target = target.rstrip("/")

    def copy(batches):
        for pdf in batches:
            done = [_lay_out(*one, target) for one in zip(pdf["path"], pdf["source_key"], pdf["fmt"])]
            laid = pd.DataFrame(done, columns=schema.fieldNames()[-7:], index=pdf.index)
            yield pd.concat([pdf.drop(columns=["source_key", "fmt"]), laid], axis=1)

    files.mapInPandas(copy, schema).write.mode("overwrite").parquet(f"{target}/{MANIFEST}")
    return files.sparkSession.read.schema(schema).parquet(f"{target}/{MANIFEST}")


def layouts(copies: DataFrame) -> list[Layout]:
    """The layouts of a manifest of copies: one driver row for each."""
    found = copies.groupBy("source_key", "fmt", "header", "kind", "folder").agg(
        F.count("*").alias("files"), F.min("path").alias("sample")).collect()
    return sorted((Layout(**r.asDict()) for r in found), key=lambda x: (x.folder, x.kind))


# -------------------------------------------------------------------- scans
CORRUPT = "_corrupt_record"


def record_schema(fields: list[str]) -> T.StructType:
    return T.StructType(all_string(fields).fields + [T.StructField(CORRUPT, T.StringType())])


def read_delimited(spark: SparkSession, folder: str, sep: str, fields: list[str]) -> DataFrame:
    """All-string scan of a folder of files sharing one delimiter and one
    header layout; the schema is the header's own order (CSV is positional). A
    quote inside a quoted field is doubled. Records with more or fewer fields
    than the header carry their text in ``_corrupt_record``."""
    return (spark.read.schema(record_schema(fields))
            .option("header", True).option("sep", sep).option("encoding", "UTF-8")
            .option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(folder)
            .withColumn("source_file", F.col("_metadata.file_name")))


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(well-formed rows, malformed rows as source_file, first_field,
    record, reject_reason); None for formats that have none."""
    if CORRUPT not in raw.columns:
        return raw, None
    # the reader counts the fields it is asked for: both sides ask for all
    fields = [c for c in raw.columns if c not in (CORRUPT, "source_file")]
    whole = F.length(F.concat_ws("", *fields)) >= 0
    bad = raw.where(whole & F.col(CORRUPT).isNotNull()).select(
        "source_file", F.col(raw.columns[0]).alias("first_field"), F.col(CORRUPT).alias("record"),
        F.lit("field_count").alias("reject_reason"))
    return raw.where(whole & F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def read_xlsx(paths: DataFrame, files: int, spec: SourceSpec) -> DataFrame:
    """Spreadsheets of one source (path): one file per task, first sheet, header
    row, columns of the source map as strings (absent ones NULL)."""
    fields = list(spec.column_map)
    dates = set(spec.date_source_columns)
    schema = T.StructType(all_string(fields).fields + [T.StructField("source_file", T.StringType())])

    def parse(batches):
        from billstar.sources.xlsx import read_rows
        for pdf in batches:
            for path in pdf["path"]:
                with fs.open_seekable(path) as book:
                    header, rows = read_rows(book, dates)
                    pos = {h: i for i, h in enumerate(header)}
                    while part := list(islice(rows, SHEET_CHUNK)):
                        cols = {f: [(r[pos[f]] if f in pos and pos[f] < len(r) else None) for r in part] for f in fields}
                        cols["source_file"] = [path.rsplit("/", 1)[-1]] * len(part)
                        yield pd.DataFrame(cols, columns=fields + ["source_file"])

    # Only the paths are shuffled; each task reads its workbook itself, so
    # file bodies never cross the network. A range over the names deals one file to a task.
    return paths.repartitionByRange(max(1, files), "path").mapInPandas(parse, schema)


def read_sources(spark: SparkSession, files: DataFrame, strict: bool = True) -> list[tuple[SourceSpec, DataFrame]]:
    """One lazy raw scan per layout. ``files`` is a manifest of laid-out
    copies; any other DataFrame with ``path`` is laid out in the shared
    scratch folder first."""
    if "bronze_path" not in files.columns:
        files = lay_out(files, scratch_dir(spark, "laid-out"))
    specs = {s.key: s for s in source_specs()}
    out = []
    for x in layouts(files):
        spec = specs[x.source_key]
        own = files.where((F.col("folder") == x.folder) & (F.col("kind") == x.kind)).select(
            F.col("bronze_path").alias("path"), "bytes")
        if x.fmt == "xlsx":
            out.append((spec, read_xlsx(own.select("path"), x.files, spec)))
            continue
        unknown = set(x.fields) - set(spec.column_map)
        if unknown and strict:
            raise ValueError(f"{x.source_key}: unknown columns {sorted(unknown)} in {x.files} files such as {x.sample}")
        if x.kind == "spans":
            out.append((spec, read_spanning(spark, own, x.sep, record_schema(x.fields), CORRUPT)))
        else:
            out.append((spec, read_delimited(spark, x.folder, x.sep, x.fields)))
    return out


# -------------------------------------------------------------------- bronze
def ingest_bronze(spark: SparkSession, input_dir: str, bronze_dir: str, ingest_date: str) -> DataFrame:
    """Raw copies of every discovered file, under
    ``bronze_dir/ingest_date=<date>/<layout>/<kind>/<name>``."""
    return lay_out(manifest(spark, input_dir), f"{bronze_dir.rstrip('/')}/ingest_date={ingest_date}")


def bronze_files(spark: SparkSession, bronze_dir: str, ingest_date: str) -> DataFrame:
    """The manifest of an ingest date's raw copies, as :func:`lay_out` left it."""
    return spark.read.parquet(f"{bronze_dir.rstrip('/')}/ingest_date={ingest_date}/{MANIFEST}")
