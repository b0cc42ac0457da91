"""Small file-system helpers over the Hadoop FileSystem API (driver side)
and pyarrow.fs (inside tasks). Paths may be any Hadoop/Arrow URL."""

from __future__ import annotations

import io
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hfs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hfs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _hfs(spark, path)
    fs.mkdirs(p)


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Data files directly under ``path`` (skips _SUCCESS, .crc, hidden)."""
    fs, p = _hfs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(st.getPath().toString())
    return sorted(out)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hfs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory())


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _hfs(spark, src)
    _, d = _hfs(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hfs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hfs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a complete file at ``path`` unless one is there: written beside
    it, then renamed without overwriting. False if another was first."""
    jvm = spark.sparkContext._jvm
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, tmp, text)
    src, dst = jvm.org.apache.hadoop.fs.Path(tmp), jvm.org.apache.hadoop.fs.Path(path)
    _, qualified = _hfs(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        qualified.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(),
        spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(src, dst, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _hfs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# ----------------------------------------------------------------- in tasks
#: URL schemes of Hadoop connectors under the name Arrow knows them by.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
                 "abfs": "abfs", "abfss": "abfss"}


def arrow_url(path: str) -> str:
    """A Hadoop-style URL as Arrow spells it; local paths lose their
    scheme. A scheme Arrow cannot read raises here, by name, instead of
    being taken for a local path."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(/.*)", path)
    if not m:
        return path
    scheme, rest = m[1].lower(), m[2]
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"tasks cannot read {scheme}: URLs ({path}); copy the files to a supported store")
    return f"{ARROW_SCHEMES[scheme]}:{rest}"


def arrow_fs(path: str):
    """(pyarrow FileSystem, path) for a Hadoop-style URL; ``file:/x`` is local."""
    from pyarrow import fs as pafs

    url = arrow_url(path)
    return pafs.FileSystem.from_uri(url) if "://" in url else (pafs.LocalFileSystem(), url)


def read_record(path: str, chunk: int = 65536) -> bytes:
    """The first delimited record of a file, however long: up to the first
    line end outside double quotes."""
    fs, p = arrow_fs(path)
    with fs.open_input_stream(p) as f:
        head, start, quoted = b"", 0, False
        while more := f.read(chunk):
            head += more
            for i in range(start, len(head)):
                c = head[i]
                if c == 0x22:
                    quoted = not quoted
                elif not quoted and c in (0x0A, 0x0D):
                    return head[:i]
            start = len(head)
        return head


def read_bytes(path: str) -> bytes:
    fs, p = arrow_fs(path)
    with fs.open_input_stream(p) as f:
        return f.read()


def open_seekable(path: str, buffer: int = 1 << 20) -> io.BufferedReader:
    """A file for random access, read from the store in pieces."""
    fs, p = arrow_fs(path)
    return io.BufferedReader(fs.open_input_file(p), buffer)


def open_output(path: str, buffer: int = 1 << 20):
    """A new file, written to the store in pieces as they come."""
    fs, p = arrow_fs(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(p, buffer_size=buffer)


def copy_file(src: str, dst: str, chunk: int = 8 << 20, seen=None) -> int:
    """Copy a file; ``seen`` is shown every chunk. The bytes copied."""
    sfs, s = arrow_fs(src)
    dfs, d = arrow_fs(dst)
    dfs.create_dir(d.rsplit("/", 1)[0], recursive=True)
    copied = 0
    with sfs.open_input_stream(s) as fin, dfs.open_output_stream(d) as fout:
        while data := fin.read(chunk):
            fout.write(data)
            copied += len(data)
            if seen:
                seen(data)
    return copied


def move_file(src: str, dst: str) -> None:
    filesystem, s = arrow_fs(src)
    _, d = arrow_fs(dst)
    filesystem.create_dir(d.rsplit("/", 1)[0], recursive=True)
    filesystem.move(s, d)
