"""URL rules, length histograms and WARC derivatives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import time
from html.parser import HTMLParser

import pytest

from billstar.llm import lengths, urlrules, warc
from billstar.llm.queries import URL_RULES, VOCABULARY, queries

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ urls
def judged(spark, urls, rules=URL_RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "'x' as host", "'y' as rule", "'z' as token")
    out = urlrules.judge(spark, pages, urlrules.rule_table(spark, rules)).collect()
    return {r.page_id: r for r in out}


def test_url_contract_cases(spark):
    urls = ["http://A.Example.NET/en/1?x", "http://example.net/enx", "https://example.com/de/#a", "http://x.org/fr/",
            "http://x.org/fr", "http://net", "http://foonet/", "http://b.net/?q=a://b.org/fr/", None, "no scheme", "",
            "http://a.net:80/", "ftp://casino-win.org/", "http://example.net.evil.com/en/", "http://x.net#/", "://net/"]
    r = judged(spark, urls)
    assert len(r) == len(urls)
    assert (r[0].host, r[0].path, r[0].rule, r[0].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert (r[1].rule, r[2].rule, r[3].rule, r[4].rule) == ("net/", "example.com/de/", "org/fr/", None)
    assert (r[5].path, r[5].rule, r[6].rule, r[7].rule) == ("", None, None, "net/")
    for i in (8, 9, 10):
        assert (r[i].host, r[i].path, r[i].rule, r[i].verdict) == ("", "", None, "allow")
    assert r[11].rule is None and r[13].rule is None and r[14].rule is None and r[15].rule == "net/"
    assert (r[12].rule, r[12].verdict, r[12].method_rule) == (None, "block", "host word casino")


def test_url_method_word_ends_the_host(spark):
    blocked = ["http://example.xxx", "http://example.xxx/a", "http://casino", "http://casino:8080/x", "http://a-poker?q",
               "http://www.Casino#top", "http://casino.example.com/"]
    allowed = ["http://casinos", "http://xcasino/", "http://example.com/casino", "http://casino:pw@example.com/"]
    r = judged(spark, blocked + allowed)
    assert [r[i].verdict for i in range(len(r))] == ["block"] * len(blocked) + ["allow"] * len(allowed)


def test_url_sql_gives_the_same_rows(spark, tmp_path):
    import duckdb

    from billstar.llm.queries import URL_RULES

    hosts = ["example.xxx", "casino", "casino:80", "a-casino:", "casino.porn.org", "porn.casino", "mycasino.org",
             "xxx.example.net", "ads-x.org", "Example.COM", "pills.net:x", "a.org"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/de/casino", "/fr/x", "/en/", "?q=casino", "#spam", "//")]
    spark.createDataFrame([(i, u) for i, u in enumerate([*urls, None, "casino", "://", "x://poker"])], "page_id long, url string") \
        .write.parquet(str(tmp_path / "p"))
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    got = urlrules.judge(spark, spark.read.parquet(str(tmp_path / "p")), urlrules.rule_table(spark, URL_RULES))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, duckdb.sql(urlrules.oracle(URL_RULES)).fetchall()))


def test_url_index_equals_trying_every_rule(spark):
    rng = random.Random(6)
    hosts = ["a.b.com", "b.com", "x-y.com", "c", "sub.c", "ads.b.com"]
    paths = ["", "/", "/p", "/p/q", "/pq/", "/p/q/r.html"]
    rules = [(h + p, rng.choice(["allow", "block"])) for h in hosts[:5] for p in paths[1:]]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(60)]
    got = judged(spark, urls, rules)
    for i, url in enumerate(urls):
        host, path = got[i].host, got[i].path
        fit = [(r, v) for r, v in rules
               if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
               and path.startswith("/" + r.split("/", 1)[1])]
        best = min(fit, key=lambda rv: (-len(rv[0]), rv[0]), default=(None, None))
        assert got[i].rule == best[0], url


def test_url_plan_is_native(spark):
    plan = queries()["op8_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop", "ExistingRDD"))


def test_url_empty_table(spark):
    assert judged(spark, []) == {}


# --------------------------------------------------------------- lengths
def test_histogram_against_brute_force(spark):
    rng = random.Random(2)
    n = [0, 0, 5] + [int(rng.paretovariate(0.5)) % 9000 for _ in range(400)]
    hist = lengths.histogram(spark.createDataFrame([(x, "k") for x in n], "n_tokens long, block string"))
    rows = hist.collect()
    assert len(rows) == len(set(n))
    for r in rows:
        L = r.n_tokens
        assert (r.documents, r.documents_le, r.documents_ge) == (
            n.count(L), sum(x <= L for x in n), sum(x >= L for x in n))
        assert (r.tokens_le, r.tokens_ge) == (sum(x for x in n if x <= L), sum(x for x in n if x >= L))
        assert r.truncated_total == sum(min(x, L) for x in n)
    limits = [0, 1, 7, 500, 8999, 10**6]
    got = lengths.truncated_totals(hist, spark.createDataFrame([(x,) for x in limits], "context long"))
    assert {r.context: r.total for r in got.collect()} == {L: sum(min(x, L) for x in n) for L in limits}
    got = {r.share: r.n_tokens for r in lengths.quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    ordered = sorted(n)
    for q, v in got.items():
        assert v == next(x for x in ordered if sum(y <= x for y in n) / len(n) >= q)


def test_histogram_of_nothing(spark):
    hist = lengths.histogram(spark.createDataFrame([], "n_tokens long"))
    assert hist.count() == 0
    got = lengths.truncated_totals(hist, spark.createDataFrame([(8,)], "context long")).first()
    assert got.total == 0
    asked = [(None,), (-3,), (5,), (5,)]
    hist = lengths.histogram(spark.createDataFrame([(3,), (9,)], "n_tokens long"))
    got = lengths.truncated_totals(hist, spark.createDataFrame(asked, "context long")).collect()
    assert sorted((r.context or 0, r.total) for r in got if r.context is not None) == [(-3, 0), (5, 8), (5, 8)]
    assert [r.total for r in got if r.context is None] == [None]


def test_each_text_is_encoded_once(spark, workdir):
    df = spark.createDataFrame([("a b",), ("c",), (None,)], "text string")
    hist = lengths.histogram(df.select(lengths.encoded_length(spark, df.text, VOCABULARY).alias("n_tokens")))
    assert "ArrowEvalPython" not in hist._jdf.queryExecution().executedPlan().toString()
    assert {r.n_tokens: r.documents for r in hist.collect()} == {0: 1, 1: 1, 2: 1}


def test_encoded_lengths(spark):
    import tiktoken

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=lengths.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "hello world", "<|endoftext|>", "é中\U0001f600  \n x", "word " * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.n for r in df.select(lengths.encoded_length(spark, df.text, VOCABULARY).alias("n")).collect()]
    assert got == [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries()["op7_token_counts"](spark, SF).collect()
    assert sum(r.documents for r in rows) == docs.count()


# ------------------------------------------------------------------ warc
PAGES = [(1, "http://a.org/", "<html><head><title>T</title><script>var x='</p>';</script></head>"
          "<body><!-- no --><p>One &amp; two<br>three</p><style>p{}</style></body></html>"),
         (2, None, "<p>x"), (3, "http://b.org/", None), (4, "http://c.org/", ""), (None, "http://d.org/", "a < b"),
         (5, "http://e.org/\u00e9", "é" * 100_000), (5, "http://e.org/\u00e9", "é" * 100_000), (6, "u", "a\r\n\r\nb")]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as headers", "2 as block")


def test_derivatives_are_linked(spark):
    source = warc.responses(pages(spark), "2024-01-01T00:00:00Z")
    by_id = {r.record_id: r for r in source.collect()}
    made = warc.derive(source, keep=["page_id"]).collect()
    assert len(made) == 2 * len(PAGES)
    for r in made:
        parent = by_id[r.headers["WARC-Refers-To"]]
        assert r.page_id == parent.page_id
        assert r.headers.get("WARC-Target-URI") == parent.headers.get("WARC-Target-URI")
        want = base64.b32encode(hashlib.sha1(r.block.encode()).digest()).decode()
        assert r.headers["WARC-Block-Digest"] == f"sha1:{want}"
        assert int(r.headers["Content-Length"]) == len(r.block.encode())
        if r.record_type == "metadata":
            assert f"source-payload-digest: {parent.headers['WARC-Payload-Digest']}" in r.block
            assert f"computed-block-digest: {parent.headers['WARC-Block-Digest']}" in r.block
            assert "http-content-type: text/html; charset=utf-8" in r.block
    text = {r.page_id: r.block for r in made if r.record_type == "conversion"}
    assert text[1] == "T\nOne & two\nthree" and text[3] == text[4] == "" and text[None] == "a < b"


def test_warc_files_round_trip(spark, workdir):
    source = warc.responses(pages(spark), "2024-01-01T00:00:00Z").drop("page_id")
    everything = source.unionByName(warc.derive(source))
    path = os.path.join(workdir, "warc")
    warc.write(everything, path)
    back = warc.read(spark, path)

    def key(df):
        return sorted((r.record_id, r.record_type, tuple(sorted(r.headers.items())), r.block) for r in df.collect())

    assert key(back) == key(everything)
    assert back.where("not intact").count() == 0
    first = next(f for f in sorted(os.listdir(path)) if f.endswith(".gz") and os.path.getsize(f"{path}/{f}") > 20)
    with gzip.open(f"{path}/{first}") as f:
        data = f.read()
    assert data.startswith(b"WARC/1.0\r\n") and data.endswith(b"\r\n\r\n")


def record(rid: str, block: bytes, length: int | None = -1, version: str = "1.0") -> bytes:
    head = f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: {rid}\r\n"
    if length is not None:
        head += f"content-length: {len(block) if length < 0 else length}\r\n"
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


INNER = b"x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\ny"
GOOD = [("<1>", b"one", None), ("<2>", INNER, None), ("<3>", b"", None), ("<4>", b"\r\n\r\n" * 3, None)]


def whole(extra: dict[int, bytes] | None = None, version: str = "1.1") -> bytes:
    return b"".join(record(rid, b, version=version) + (extra or {}).get(i, b"") for i, (rid, b, _) in enumerate(GOOD))


@pytest.mark.parametrize("bad, found", [
    (record("<b>", b"none", None), ("<b>", b"", "no length")),
    (record("<b>", b"short", 2), ("<b>", b"sh", "wrong length")),
    (record("<b>", b"long", 30), ("<b>", b"long", "wrong length")),
    (record("<b>", b"long", 10 ** 6), ("<b>", b"long", "wrong length")),
    (record("<b>", b"huge", 10 ** 12), ("<b>", b"", "too long")),
    (b"\r\nstray line\r\n", None)])
def test_damaged_records_are_told_and_spoil_no_other(bad, found):
    for at in range(len(GOOD)):
        for version in ("1.0", "1.1"):
            want = [*GOOD[:at + 1], *([found] if found else []), *GOOD[at + 1:]]
            got = [(h["WARC-Record-ID"], b, f) for h, b, f in
                   warc.records_of(io.BytesIO(whole({at: bad}, version)))]
            if found and found[1] == b"long" and at == len(GOOD) - 1:  # nothing follows that shows the block's end
                want[-1] = ("<b>", b"long\r\n\r\n", "cut off")
            assert got == want


@pytest.mark.parametrize("packed", [False, True])
def test_archives_are_read_by_their_lengths(spark, workdir, packed):
    body = whole({3: record("<b>", b"cut here")[:-8]})
    if packed:  # a member for each record, the last one damaged
        body = b"".join(gzip.compress(record(r, b)) for r, b, _ in GOOD) + gzip.compress(record("<b>", b"x" * 9))[:-12]
    with open(os.path.join(workdir, "a.warc.gz" if packed else "a.warc"), "wb") as f:
        f.write(body)
    back = warc.read(spark, workdir)
    assert {r.record_id: r.block.encode() for r in back.where("intact").collect()} == {r: b for r, b, _ in GOOD}
    made = warc.derive(back).collect()
    assert {r.headers["WARC-Refers-To"] for r in made} == {r for r, _, _ in GOOD}
    assert packed or [tuple(r) for r in warc.damaged(back).collect()] == [("<b>", "response", "cut off")]


def test_pages_that_differ_have_ids_of_their_own(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (None, "u", "a"), (None, "u", "b"), (None, None, "a"), (1, "u", "a")]
    source = warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"), "d")
    assert source.select("record_id").distinct().count() == 5
    assert warc.derive(source).select("record_id").distinct().count() == 10


def test_hostile_pages_take_linear_time():
    for unit in ("<p ", "<", "<!--", "<script ", "</p", "<div <", "&", "<style>"):
        begin = time.monotonic()
        warc.plain_text(unit * 400_000)
        assert time.monotonic() - begin < 5, unit


class Reader(HTMLParser):
    """Brute force of the page text: a parser's events instead of patterns."""

    SKIP = {"script", "style", "noscript", "template"}
    LINE = set("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
               " header hr li main nav ol p pre section table td th title tr ul".split())

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.skip += tag in self.SKIP
        self.out.append("\n" if tag in self.LINE else "")

    def handle_endtag(self, tag):
        self.skip -= tag in self.SKIP
        self.out.append("\n" if tag in self.LINE else "")

    def handle_data(self, data):
        self.out.append("" if self.skip else data)

    def text(self) -> str:
        lines = (" ".join(line.split()) for line in "".join(self.out).split("\n"))
        return "\n".join(filter(None, lines))


def test_the_query_against_a_parser(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries()["op4_warc_derivatives"](spark, SF).where("record_type = 'conversion'").collect()
    assert sorted(r.page_id for r in rows) == sorted(html)
    source = warc.responses(spark.read.parquet(f"{SF}/pages.parquet"), "d")
    made = warc.derive(source, keep=["page_id"]).where("record_type = 'conversion'").collect()
    for r in made:
        assert r.block == Reader(html[r.page_id]).text()


def test_other_records_derive_nothing(spark):
    rows = [("<a>", "request", {"WARC-Type": "request"}, "x"), (None, "response", {}, "y"),
            ("<b>", "response", None, None)]
    made = warc.derive(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert [r.headers["WARC-Refers-To"] for r in made] == ["<b>", "<b>"]


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<!--", "<script>never closed", "&#0;&bogus;"])
def test_plain_text_never_fails(html):
    assert "<script" not in warc.plain_text(html)
