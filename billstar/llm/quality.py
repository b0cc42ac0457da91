"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on windows of good and one on
windows of bad labelled text. A text is cut into windows, all of which are
compressed with either dictionary; the dictionary that knows the text
better makes it smaller. The normalised size difference

    gain = (bad_size - good_size) / (bad_size + good_size + damping)

and the compression ratio go through a logistic calibration to a score.

Both dictionaries and the calibration come from a bounded sample of
labelled rows (``per_class``); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.llm.common import fold, fresh, label_sample, logistic_fit, logistic_predict

#: Bytes of a window: short enough that the dictionary, not the window's
#: own repetitions, explains most matches.
WINDOW = 1024
#: Windows of one sample document, spread evenly over it.
WINDOWS_PER_DOC = 8
DICT_BYTES = 1 << 17
LEVEL = 3
#: Bytes added to the divisor so that very short texts stay undecided.
DAMPING = 24
HOLDOUT_MOD, HOLDOUT_AT = 3, 1


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    calibration: tuple | None


def windows(data: bytes) -> list[bytes]:
    return [data[i:i + WINDOW] for i in range(0, len(data), WINDOW)]


def _compressor(dictionary: bytes):
    import zstandard as zs

    kind = zs.DICT_TYPE_AUTO if dictionary[:4] == b"\x37\xa4\x30\xec" else zs.DICT_TYPE_RAWCONTENT
    d = zs.ZstdCompressionDict(dictionary, dict_type=kind)
    d.precompute_compress(level=LEVEL)
    return zs.ZstdCompressor(
        level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def measurer(good: bytes, bad: bytes):
    """text -> (gain, log ratio) over all windows of the text; (0, 0) for
    NULL and empty texts."""
    from math import log

    with_good, with_bad = _compressor(good), _compressor(bad)

    def measure(text: str | None) -> tuple[float, float]:
        data = (text or "").encode("utf-8", "replace")
        if not data:
            return 0.0, 0.0
        parts = windows(data)
        g = sum(len(with_good.compress(w)) for w in parts)
        b = sum(len(with_bad.compress(w)) for w in parts)
        return (b - g) / (b + g + DAMPING), log((b + g + DAMPING) / (2 * len(data) + DAMPING))

    return measure


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of at most DICT_BYTES; with too few samples
    for training, their raw bytes serve as one."""
    import zstandard as zs

    raw = b"".join(samples)[-DICT_BYTES:] or b"\n"
    if len(samples) < 16:
        return raw
    try:
        return zs.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zs.ZstdError:
        return raw


def fit(documents: DataFrame, labels: DataFrame, per_class: int = 3000,
        mod: int = HOLDOUT_MOD, at: int = HOLDOUT_AT) -> QualityModel:
    """Learn from at most ``per_class`` documents of each class whose id's
    fold is not ``at``. Half of them feed the dictionaries, which are
    trained in one task per class; the others the calibration. Only the
    two dictionaries and three numbers per calibration row reach the driver.
    A class without rows leaves the score at the known class's side."""
    sample = label_sample(documents, labels, "quality", fold("doc_id", mod) != at, {0: per_class, 1: per_class})
    part = F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string"))) % 2

    def cut(batches: Iterator) -> Iterator:
        for pdf in batches:
            rows = []
            for label, text in zip(pdf.label, pdf.text):
                parts = windows(text.encode("utf-8", "replace"))
                step = max(1, -(-len(parts) // WINDOWS_PER_DOC))
                rows += [(label, w) for w in parts[::step]]
            yield pd.DataFrame(rows, columns=["label", "w"])

    def train(pdf):
        pieces = sorted(pdf.w.tolist(), key=hash_order)
        return pd.DataFrame([(int(pdf.label.iloc[0]), train_dictionary(pieces))], columns=["label", "d"])

    dictionaries = {
        r.label: bytes(r.d)
        for r in sample.where(part == 0).select("label", "text")
        .mapInPandas(cut, "label int, w binary")
        .groupBy("label").applyInPandas(train, "label int, d binary").collect()
    }
    good, bad = dictionaries.get(1, b"\n"), dictionaries.get(0, b"\n")

    def features(batches: Iterator) -> Iterator:
        measure = measurer(good, bad)
        for pdf in batches:
            yield pd.DataFrame(
                [(y, *measure(t)) for y, t in zip(pdf.label, pdf.text)], columns=["y", "gain", "ratio"]
            )

    rows = (
        sample.where(part == 1).select("label", "text")
        .mapInPandas(features, "y int, gain double, ratio double").collect()
    )
    rows.sort()
    model = logistic_fit([(r.gain, r.ratio) for r in rows], [r.y for r in rows]) if rows else None
    return QualityModel(good, bad, model)


def hash_order(data: bytes) -> int:
    """Order of the training windows that no partitioning changes."""
    from zlib import crc32

    return crc32(data)


def score(text: Column, model: QualityModel) -> Column:
    """struct(score, gain) of a text column, per Arrow batch. Empty and
    NULL texts measure (0, 0) and get the score of that point."""

    @F.pandas_udf(T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("gain", T.DoubleType())
    ]))
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        measure = measurer(model.good, model.bad)
        for texts in batches:
            x = np.array([measure(t) for t in texts], dtype=float).reshape(-1, 2)
            p = logistic_predict(model.calibration, x) if model.calibration else np.full(len(x), 0.5)
            yield pd.DataFrame({"score": p, "gain": x[:, 0]})

    return scored(text)


def classify(documents: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted, gain.

    Every row gives a row: NULL ids stay NULL, repeated rows repeat, other
    columns of ``documents`` are not carried, so their names cannot clash.
    """
    out = documents.select("doc_id", score(F.col("text"), model).alias("s"))
    return out.select(
        "doc_id",
        (fold("doc_id", HOLDOUT_MOD) == HOLDOUT_AT).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        F.col("s.gain").alias("gain"),
    )


def keep_good(documents: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score at least ``threshold``, unchanged."""
    name = fresh("_quality_score", documents.columns)
    return (
        documents.withColumn(name, score(F.col("text"), model)["score"])
        .where(F.col(name) >= threshold).drop(name)
    )
