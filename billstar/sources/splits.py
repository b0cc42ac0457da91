"""Delimited files whose quoted fields go over line ends, read in splits (A4).

A split can't tell from its own bytes whether it starts inside quotes. So
the files are passed over twice: first each split works out, for each state
it may start in, the state it ends in; these are composed from split to
split along each file; then each split reads the records that begin in it.
Only a few numbers per split are exchanged.

States: outside quotes, inside, and inside right behind a quote that is
either a closing one or the first half of a doubled one. A quote opens a
field only at its start, so a stray quote inside a field changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.session import scratch_dir
from billstar.sources import fs

#: Bytes of a split, and what a record beyond its split's end is read on by.
SPLIT, MORE = 32 << 20, 1 << 20
OUTSIDE, INSIDE, QUOTE = 0, 1, 2
BOM = b"\xef\xbb\xbf"


def quoted_spans(data: bytes, state: int, before: int, sep: str) -> tuple[list[int], list[int], int]:
    """Starts and ends of the quoted stretches of ``data``, which begins in
    ``state`` behind the byte ``before``, and the state at its end."""
    openers = (*sep.encode(), 0x0A, 0x0D)
    starts, ends, pos = [], [], 0
    if state == QUOTE and data:
        state = INSIDE if data[0] == 0x22 else OUTSIDE
        pos = int(state == INSIDE)
    if state == INSIDE:
        starts.append(0)
    while (p := data.find(b'"', pos)) >= 0:
        pos = p + 1
        if state == OUTSIDE:
            if (data[p - 1] if p else before) in openers:
                state = INSIDE
                starts.append(p)
        elif pos == len(data):
            ends.append(pos)
            return starts, ends, QUOTE
        elif data[pos] == 0x22:
            pos += 1
        else:
            state = OUTSIDE
            ends.append(pos)
    if state == INSIDE:
        ends.append(len(data))
    return starts, ends, state


def record_ends(data: bytes, state: int, before: int, sep: str) -> np.ndarray:
    """Places of the line ends outside quotes; of CR LF the LF."""
    starts, ends, _ = quoted_spans(data, state, before, sep)
    raw = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero((raw == 0x0A) | (raw == 0x0D))
    if len(starts):
        i = np.searchsorted(starts, at, side="right") - 1
        at = at[(i < 0) | (at >= np.asarray(ends)[i])]
    pair = np.zeros(len(at), dtype=bool)
    pair[:-1] = (raw[at[:-1]] == 0x0D) & (raw[at[1:]] == 0x0A) & (np.diff(at) == 1)
    return at[~pair]


def _range(path: str, start: int, length: int) -> tuple[bytes, int]:
    """``length`` bytes from ``start``, and the byte before them (a line end at the file's start)."""
    filesystem, p = fs.arrow_fs(path)
    with filesystem.open_input_file(p) as f:
        f.seek(max(0, start - 1))
        data = f.read(length + (start > 0))
    if not start:
        return data.removeprefix(BOM), 0x0A
    return data[1:], data[0]


def records(path: str, start: int, length: int, state: int, sep: str) -> Iterator[bytes]:
    """The records that begin in a split, without their line ends; the
    file's first one, its header, and empty lines are left out."""
    data, before = _range(path, start, length)
    if not data:
        return
    ends = record_ends(data, state, before, sep)
    # a record begins behind a line end; one right at the start if that line end is the byte before
    begins = ends + 1
    whole_line = before == 0x0A or (before == 0x0D and data[:1] != b"\n")
    if not start or (state == OUTSIDE and whole_line):
        begins = np.append(0, begins)
    begins = begins[begins < len(data)]
    for i, b in enumerate(begins):
        if not (start == 0 and i == 0):
            e = int(np.searchsorted(ends, b))
            record = data[b:ends[e]] if e < len(ends) else _rest(path, data[b:], start + length, sep)
            record = record.rstrip(b"\r")
            if record.strip():
                yield record


def _rest(path: str, head: bytes, at: int, sep: str) -> bytes:
    """A record that goes on behind its split."""
    filesystem, p = fs.arrow_fs(path)
    more = MORE
    with filesystem.open_input_file(p) as f:
        f.seek(at)
        while chunk := f.read(more):
            head += chunk
            ends = record_ends(head, OUTSIDE, 0x0A, sep)
            if len(ends):
                return head[:ends[0]]
            more *= 2
    return head


def split_states(spark: SparkSession, files: DataFrame, sep: str, size: int = SPLIT) -> tuple[DataFrame, int]:
    """((path, start, length, state), number of splits) of the files (path,
    bytes): the state each split starts in."""
    n = int(files.agg(F.sum(F.expr(f"greatest(1, ceil(bytes / {size}))")).alias("n")).first().n or 1)
    splits = files.select("path", "bytes", F.explode(F.expr(f"sequence(0L, greatest(0L, bytes - 1) div {size})")).alias("i"))
    splits = splits.selectExpr(
        "path", f"i * {size} as start", f"least({size}L, bytes - i * {size}) as length").repartition(n, "path", "start")

    def passed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, start, length in zip(pdf.path, pdf.start, pdf.length):
                data, before = _range(path, int(start), int(length))
                out.append([quoted_spans(data, s, before, sep)[2] for s in (OUTSIDE, INSIDE, QUOTE)])
            yield pdf.assign(exits=out)

    steps = splits.mapInPandas(passed, "path string, start long, length long, exits array<int>")
    along = steps.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "length", "exits"))).alias("s"))
    along = along.selectExpr("path", f"""inline(aggregate(s,
        named_struct('state', {OUTSIDE}, 'out', cast(array() as array<struct<start:bigint,length:bigint,state:int>>)),
        (a, x) -> named_struct('state', x.exits[a.state],
                               'out', concat(a.out, array(named_struct('start', x.start, 'length', x.length, 'state', a.state)))),
        a -> a.out))""")
    place = scratch_dir(spark, "splits")
    along.write.parquet(place)
    return spark.read.schema("path string, start long, length long, state int").parquet(place), n


def read_spanning(spark: SparkSession, files: DataFrame, sep: str, schema: T.StructType, corrupt: str,
                  size: int = SPLIT) -> DataFrame:
    """All-string scan of files (path, bytes) of one delimiter and header
    layout, a task for each split, with the same columns as a scan by lines."""
    states, n = split_states(spark, files, sep, size)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start, length, state in zip(pdf.path, pdf.start, pdf.length, pdf.state):
                name, out, held = path.rsplit("/", 1)[-1], [], 0
                for r in records(path, int(start), int(length), int(state), sep):
                    out.append(r.decode("utf-8", errors="replace"))
                    held += len(r)
                    if held >= MORE:
                        yield pd.DataFrame({"value": out, "source_file": name})
                        out, held = [], 0
                yield pd.DataFrame({"value": pd.Series(out, dtype=object), "source_file": name})

    text = states.repartition(n, "path", "start").mapInPandas(read, "value string, source_file string")
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true",
               "columnNameOfCorruptRecord": corrupt}
    return text.select(F.from_csv("value", schema.toDDL(), options).alias("r"), "source_file").select("r.*", "source_file")
