"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed character 1- to 3-grams,
normalised to length one. Each language has several centroids, found by
spherical k-means over a bounded sample of its labelled documents. A text
gets the language of the centroid of highest cosine; further from it than
``reject`` it counts as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstar.llm.common import fold, written

DIM = 4096
#: Documents of a language that feed its centroids, and their number.
PER_LANGUAGE, CENTROIDS = 1500, 4
#: Characters that are vectorised at once; longer texts go in such pieces.
PIECE = 1 << 20
HOLDOUT_MOD, HOLDOUT_AT = 5, 0
_M1, _M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


@dataclass(frozen=True)
class LanguageModel:
    languages: list
    idf: np.ndarray
    #: (language index, unit vector) of each centroid, stacked.
    owner: np.ndarray
    centroids: np.ndarray
    reject: float = 0.3


def counts(text: str | None) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of the lower-cased text; what is
    not a letter becomes one blank."""
    total = np.zeros(DIM, dtype=np.float64)
    text = (text or "").lower()
    for start in range(0, len(text), PIECE):
        piece = text[max(0, start - 2):start + PIECE]
        code = np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32)
        low = code < 128
        letter = np.where(low, (code >= 97) & (code <= 122), code >= 0xAA)
        code = np.where(letter, code, np.uint32(32))
        keep = np.ones(len(code), dtype=bool)
        keep[1:] = letter[1:] | letter[:-1]
        code = code[keep]
        h = code.copy()
        for n in range(3):
            if n:
                h = (h[:-1] * _M1) ^ (code[n:] * _M2)
            total += np.bincount((h * _M1) >> np.uint32(20), minlength=DIM)
    return total


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors (rows) of count rows; zero rows stay zero."""
    v = np.log1p(c) * idf
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def kmeans(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out first centroids: each next one is
    the row least similar to those before it. No randomness."""
    k = min(k, len(x))
    first = x.mean(0)
    chosen = [int(np.argmax(x @ first))]
    best = x @ x[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(steps):
        near = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[near == j].sum(0) if (near == j).any() else c[j] for j in range(k)])
        c /= np.linalg.norm(c, axis=1, keepdims=True) + 1e-12
    return c


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, k: int = CENTROIDS,
        mod: int = HOLDOUT_MOD, at: int = HOLDOUT_AT) -> LanguageModel:
    """Learn from about ``per_language`` documents of each non-NULL lang whose id's fold
    is not ``at``.

    The sample is a hash threshold on the ids of each language, from their
    number: an id that repeats counts once and comes once, with its first
    text by code point, so the ids picked are few enough to broadcast. The
    languages and centroids that reach the driver are bounded
    by the number of languages. Each language is clustered in a task of
    its own, over count vectors, not texts. Centroids that draw mostly
    another language's sample are left out; each language keeps one.
    """
    known = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", mod) != at))
    ids = written(documents.sparkSession, known.select("lang", "doc_id").distinct(), "language-ids")
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    picked = ids.join(sizes, "lang").where(share < per_language / F.col("n")).select("lang", "doc_id")
    sample = known.join(F.broadcast(picked), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(
        F.min("text").alias("text"))
    languages = sorted(r.lang for r in sizes.select("lang").collect())
    if not languages:
        return LanguageModel([], np.ones(DIM), np.zeros(0, int), np.zeros((0, DIM)))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "lang": pdf.lang, "v": [np.log1p(counts(t)).astype(np.float32).tobytes() for t in pdf.text]})

    # written once: the three passes below read vectors, not the documents again
    counted = written(documents.sparkSession, sample.select("lang", "text").mapInPandas(
        vectors, "lang string, v binary"), "language-sample")

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM), 0
        for pdf in batches:
            for v in pdf.v:
                df += np.frombuffer(v, dtype=np.float32) > 0
                n += 1
        yield pd.DataFrame({"i": np.arange(DIM + 1), "n": np.append(df, n)})

    present = counted.select("v").mapInPandas(presence, "i int, n double").groupBy("i").agg(F.sum("n").alias("n"))
    df = np.zeros(DIM + 1)
    for r in present.collect():
        df[r.i] = r.n
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.stack([np.frombuffer(b, dtype=np.float32) for b in sorted(pdf.v)]).astype(np.float64) * idf
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pd.DataFrame({"lang": [], "c": []})
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        c = kmeans(v, k)
        return pd.DataFrame({"lang": [pdf.lang.iloc[0]] * len(c), "c": [row.tobytes() for row in c]})

    found = sorted(
        (r.lang, bytes(r.c)) for r in
        counted.groupBy("lang").applyInPandas(cluster, "lang string, c binary").collect())
    owner = np.array([languages.index(lang) for lang, _ in found], dtype=int)
    centroids = np.stack([np.frombuffer(c) for _, c in found]) if found else np.zeros((0, DIM))

    # a cluster that draws more sample documents of another language holds
    # passages in that language, not its own
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = np.stack([np.frombuffer(b, dtype=np.float32) for b in pdf.v]) * idf
            yield pd.DataFrame({"lang": pdf.lang, "j": np.argmax(v @ centroids.T, axis=1)})

    drawn = np.zeros((len(found), len(languages)))
    if found:
        for r in counted.mapInPandas(nearest, "lang string, j int").groupBy("lang", "j").count().collect():
            drawn[r.j, languages.index(r.lang)] = r["count"]
    own = drawn[np.arange(len(found)), owner]
    pure = own >= drawn.max(axis=1, initial=0)
    for k in set(owner):
        if not pure[owner == k].any():
            pure[np.flatnonzero(owner == k)[np.argmax(own[owner == k])]] = True
    return LanguageModel(languages, idf, owner[pure], centroids[pure])


def predict(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score, rejected) of a text column. The score is the
    cosine to the nearest centroid, within 0 and 1; ``und`` with 0 where
    the text is NULL, empty or without a letter, or nothing was learnt."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for i in range(0, len(texts), 64):
                part = texts.iloc[i:i + 64]
                cos = weighted(np.stack([counts(t) for t in part]), model.idf) @ model.centroids.T
                for t, row in zip(part, cos):
                    if not len(row) or not has_letter(t):
                        out.append(("und", 0.0, True))
                        continue
                    j = int(np.argmax(row))
                    s = float(min(1.0, max(0.0, row[j])))
                    out.append((model.languages[model.owner[j]], s, s < model.reject))
            yield pd.DataFrame(out, columns=["lang", "score", "rejected"])

    return predicted(text)


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score,
    rejected (the nearest centroid is further than the model allows).
    NULL ids stay NULL, repeated rows repeat; other columns are not carried."""
    out = documents.select("doc_id", predict(F.col("text"), model).alias("p"))
    return out.select(
        "doc_id", (fold("doc_id", HOLDOUT_MOD) == HOLDOUT_AT).alias("held_out"),
        F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.rejected").alias("rejected"))
