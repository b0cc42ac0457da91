"""The pipeline stage by stage, and the registry of the subpackage."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
import regex

import corpus_pipeline
from billstar.llm import minhash, quality, toxicity
from billstar.llm.common import logistic_predict, table, written
from billstar.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_registry():
    keys = queries()
    assert [sum(k.startswith(f"op{n}_") for k in keys) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in keys and set(oracle_sql()) <= set(keys)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_only_remove(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF), f"test-{name}")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before
        before = ids
        if name != "mixing":
            assert docs.columns == columns
    assert set(docs.columns) > set(columns) and docs.count() > 0
    assert queries()["pipeline"](spark, SF).count() == docs.count()


def test_run_equals_a_brute_force_pipeline(spark):
    """Every stage again in plain Python over the rows the one before kept:
    scores row by row, all pairs, all alignments, one queue."""
    from test_minhash import brute as all_pairs
    from test_mixing import brute as one_queue

    docs = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    labels = table(spark, SF, "labels")

    def frame(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, source string")

    model = quality.fit(frame(docs), labels)
    measure = quality.measurer(model.good, model.bad)
    docs = [d for d in docs if logistic_predict(model.calibration, [measure(d[1])])[0] >= 0.5]

    model = toxicity.fit(frame(docs), labels)
    reader, machine = toxicity.Reader(model.lexicon), toxicity.grammar()
    docs = [d for d in docs if logistic_predict(
        model.calibration, [toxicity.features(d[1], reader, machine)])[0] < 0.3]

    groups = all_pairs(docs, minhash.Params(words=5, percent=80))
    docs = [d for d in docs if groups[d[0]][1] == d[0]]

    def tokens(text):
        return regex.findall(r"[\p{L}\p{N}]+", text.lower())

    items = [tokens(r.text) for r in table(spark, SF, "benchmark").collect()]

    def overlaps(text):
        w = tokens(text)
        for b in items:
            if len(b) < 11:
                continue
            stretch = min(13, len(b))
            for d in range(stretch - len(b), len(w) - stretch + 1):
                same = [w[i] == b[i - d] for i in range(max(d, 0), min(len(w), len(b) + d))]
                if any(sum(same[i:i + stretch]) >= 0.8 * stretch for i in range(len(same) - stretch + 1)):
                    return True
        return False

    docs = [d for d in docs if not overlaps(d[1])]
    mix = one_queue(docs)
    want = Counter({row[0]: taken // row[1] for row, (_, _, taken) in mix.items() if row[1] and taken})
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect())
    assert got == want


def test_stages_take_clashing_columns(spark):
    extra = ["_id", "_alt", "_quality_score", "_toxicity_score", "alt", "component_id", "size", "row", "a.b", "mix_pass"]
    docs = table(spark, SF, "documents").selectExpr("*", *[f"doc_id as `{c}`" for c in extra])
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = written(spark, stage(spark, docs, SF), f"clash-{name}")
        assert [c for c in docs.columns if c != "mix_finish"] == columns
        if name != "mixing":
            assert docs.where("`a.b` <> doc_id or _id <> doc_id").count() == 0


def test_stages_take_empty_documents(spark):
    docs = table(spark, SF, "documents").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_oracle_agreement(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[key](spark, SF)
    res = con.execute(oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)

    def norm(row):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in row)

    got = sorted(map(norm, map(tuple, df.select(*names).collect())), key=str)
    assert got == sorted(map(norm, res.fetchall()), key=str)
