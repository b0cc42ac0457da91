"""Lossless ingest: quoted fields, long headers, malformed records, source
keys, deliveries; URL schemes and the shared folder of a cluster."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from billstar import session
from billstar.config import RunOptions, resolve_source_key
from billstar.operators.standardize import build_silver, read_and_standardize
from billstar.plans import runner
from billstar.plans import warehouse as W
from billstar.sources import files, fs
from tests.conftest import write_text
from tests.test_sources import RUN_TS, SRC1, make_inputs

HEADER = SRC1.split("\n", 1)[0]
OPTS = RunOptions(as_of=dt.date(2025, 6, 1), run_ts=dt.datetime(2025, 6, 1), strict=False)
TAIL = "ETAB001,Clinique ETAB001,URGENCES,05/01/2025,100.50,PAYE,100.50,25/01/2025,3"


def test_quoted_fields(spark, workdir):
    write_text(os.path.join(workdir, "etablissement1_facturation.csv"),
               f'{HEADER}\nA1,"Du ""Pont""",Jean,{TAIL}\nA2,"Du\nPont, fils",Jean,{TAIL}\n')
    rows = {r.patient_id: r for r in build_silver(spark, files.manifest(spark, workdir), RUN_TS).collect()}
    assert {k: r.patient_nom for k, r in rows.items()} == {"A1": 'Du "Pont"', "A2": "Du\nPont, fils"}
    assert rows["A2"].nombre_lignes == 3


def test_files_with_line_breaks_in_quotes_lie_apart(spark, workdir):
    write_text(os.path.join(workdir, "etablissement1 b.csv"), f'{HEADER}\n"x\ny"\n')
    write_text(os.path.join(workdir, "etablissement1_c.csv"), f'{HEADER}\n"x ""y"""\n')
    copies = files.lay_out(files.manifest(spark, workdir), f"{workdir}/bronze")
    assert {r.bronze_path.rsplit("/", 1)[-1]: r.kind for r in copies.collect()} == {
        "etablissement1 b.csv": "spans", "etablissement1_c.csv": "lines"}


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_odd_lines_are_seen_in_any_chunks(chunk):
    for text, odd in ((b'a,"b"\n"c""d"\n', False), (b'a\n"b\nc"\n', True), (b'x"\r\n"y\r\n', True), (b'"x', True),
                      (b"", False), (b"a\nb", False), (b'"a"', False)):
        q = files.LineQuotes()
        for i in range(0, len(text), chunk):
            q.add(text[i:i + chunk])
        assert q.any() == odd, text


def test_header_longer_than_a_chunk_and_quoted(workdir):
    path = write_text(os.path.join(workdir, "x.csv"), "a" * 70_000 + ',"b\n,c"\nrow\n')
    assert fs.read_record(path).endswith(b',"b\n,c"')
    assert len(fs.read_record(path, chunk=7)) == 70_000 + 7
    assert files.header_fields('a,"b,c", d', ",") == ["a", "b,c", "d"]


def test_malformed_records_are_kept_apart(spark, workdir):
    write_text(os.path.join(workdir, "etablissement1_facturation.csv"),
               f"{HEADER}\nA1,Dupont,Jean,{TAIL}\nA2,short,row\nA3,Dupont,Jean,{TAIL},9,9\n")
    good, bad = read_and_standardize(spark, files.manifest(spark, workdir), RUN_TS)
    assert [r.patient_id for r in good.collect()] == ["A1"]
    assert sorted((r.record.split(",")[0], r.reject_reason) for r in bad.collect()) == [
        ("A2", "field_count"), ("A3", "field_count")]


def test_a_digit_after_the_key_is_another_source():
    assert resolve_source_key("etablissement1_x.csv") == "etablissement1"
    with pytest.raises(ValueError):
        resolve_source_key("etablissement10_x.csv")


def test_second_delivery_is_loaded_and_a_repeat_is_told(spark, workdir):
    inputs, root = os.path.join(workdir, "in"), os.path.join(workdir, "wh")
    os.makedirs(inputs)
    make_inputs(inputs)
    first = runner.run(spark, inputs, root, OPTS)
    assert not first["skipped"] and first["batch"].inserted_facts > 0
    again = runner.run(spark, inputs, root, OPTS)
    assert again["skipped"] and again["batch"] is None
    write_text(os.path.join(inputs, "etablissement1_more.csv"), f"{HEADER}\nNEW,Dupont,Jean,{TAIL}\n")
    second = runner.run(spark, inputs, root, OPTS)
    assert (second["skipped"], second["batch"].silver_rows, second["batch"].inserted_facts) == (False, 1, 1)


def test_options_have_no_default_date():
    with pytest.raises(TypeError):
        RunOptions()
    assert abs((RunOptions.today().as_of - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_url_schemes():
    assert fs.arrow_url("s3a://bucket/k") == "s3://bucket/k"
    assert fs.arrow_url("hdfs://nn:8020/k") == "hdfs://nn:8020/k"
    assert fs.arrow_url("file:/a/b") == fs.arrow_url("file:///a/b") == fs.arrow_url("/a/b") == "/a/b"
    for url in ("dbfs:/mnt/x", "wasbs://c@a/x"):
        with pytest.raises(ValueError):
            fs.arrow_url(url)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master):
            self.sparkContext = Context(master)
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})

    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(Session(master))


# --------------------------------------------------------------- commits
def test_two_writers_conflict_and_lose_nothing(spark, workdir):
    root = os.path.join(workdir, "wh")
    one, two = (spark.range(n).withColumnRenamed("id", "x") for n in (3, 2))
    base = W.state(spark, root)
    a = W.write_part(one, root, W.new_path(root, "t", "a"))
    b = W.write_part(two, root, W.new_path(root, "t", "b"))
    assert W.read_table(spark, root, "t") is None
    W.commit(spark, root, base, batch="a", add={"t": a})
    with pytest.raises(W.ConflictError):
        W.commit(spark, root, base, batch="b", add={"t": b})
    assert W.read_table(spark, root, "t").count() == 3
    W.commit(spark, root, W.state(spark, root), batch="b", add={"t": b})
    assert W.read_table(spark, root, "t").count() == 5 and W.state(spark, root).batches == ("a", "b")


def test_create_reset_and_snapshots(spark, workdir):
    root = os.path.join(workdir, "wh")
    W.create(spark, root)
    assert W.state(spark, root) == W.State()
    for n in (4, 6):
        W.publish(spark.range(n), spark, root, "mart", W.state(spark, root))
        assert W.read_table(spark, root, "mart").count() == n
    W.commit(spark, root, W.state(spark, root), batch="b", add={}, max_staging_id=9)
    W.reset(spark, root)
    assert W.read_table(spark, root, "mart") is None
    assert W.state(spark, root).batches == () and W.max_staging_id(spark, root) == 9


@pytest.mark.parametrize("step", ["write_silver", "write_part", "commit"])
def test_failure_at_any_step_shows_the_old_state(spark, workdir, monkeypatch, step):
    inputs, root = os.path.join(workdir, "in"), os.path.join(workdir, "wh")
    os.makedirs(inputs)
    make_inputs(inputs)
    runner.run_batch(spark, files.manifest(spark, inputs), root, OPTS, "b1")
    before = W.state(spark, root)
    real, calls = getattr(W, step), []

    def fail(*args, **kw):
        calls.append(1)
        if step != "write_part" or len(calls) == 6:       # the fact, after staging and dimensions
            raise RuntimeError("lost")
        return real(*args, **kw)

    monkeypatch.setattr(W, step, fail)
    with pytest.raises(RuntimeError):
        runner.run_batch(spark, files.manifest(spark, inputs), root, OPTS, "b2")
    assert W.state(spark, root) == before


def test_old_month_redelivered_is_suppressed_and_pruned(spark, workdir):
    inputs, root = os.path.join(workdir, "in"), os.path.join(workdir, "wh")
    os.makedirs(inputs)
    make_inputs(inputs)
    first = runner.run_batch(spark, files.manifest(spark, inputs), root, OPTS, "b1")
    later = os.path.join(workdir, "later")
    os.makedirs(later)
    write_text(os.path.join(later, "etablissement1_z.csv"), f"{HEADER}\n00123,Dupont,Jean,{TAIL}\n")
    second = runner.run_batch(spark, files.manifest(spark, later), root, OPTS, "b2")
    assert (second.staged_rows, second.inserted_facts) == (1, 0)
    fact = W.read_table(spark, root, "fact_facturation")
    assert fact.count() == first.inserted_facts
    plan = fact.where("mois_facturation in (202501)")._jdf.queryExecution().executedPlan().toString()
    assert "202501" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_labels_are_published_and_read_back(spark, workdir):
    """Enough unpaid rows to score: labels reach fact, view and mart."""
    inputs, root = os.path.join(workdir, "in"), os.path.join(workdir, "wh")
    os.makedirs(inputs)
    rows = "\n".join(f"P{i},N,F,ETAB001,Clinique,URGENCES,{1 + i % 28:02d}/0{1 + i % 3}/2025,{100 + 7 * i},IMPAYE,0,,1"
                     for i in range(60))
    write_text(os.path.join(inputs, "etablissement1_facturation.csv"), f"{HEADER}\n{rows}\n")
    summary = runner.run(spark, inputs, root, OPTS)
    assert summary["scored"] == 60
    labels = [r.anomaly_score for r in runner.read_fact(spark, root).collect()]
    assert len(labels) == 60 and set(labels) <= {-1, 1} and labels.count(-1) == 3
    assert spark.table("v_stats_etablissement").first().nombre_anomalies == 3
    assert runner.read_mart(spark, root, OPTS).where("priorite = 'URGENT'").count() > 0
    runner.score_and_publish(spark, root, OPTS)
    assert W.read_table(spark, root, "anomaly_scores").count() == 60
