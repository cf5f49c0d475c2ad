"""Table functions, line numbers by splits, names by grams, marks, and counts told while a job runs."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from gavel.functions import names
from gavel.operators import catalogue, lookups, reports, scans
from gavel.sources import html, tables
from gavel.streaming import watch


@pytest.fixture(scope="module")
def pages(spark):
    tables.register(spark)
    text = "<h2 id=a>T</h2><table><tr><td>x</td><td><a href='/m'>m</a></td></tr></table><select name=o><option value=1>One</option></select><div class=card><h3>C</h3><a href=/c>c</a><dl><dt>k</dt><dd>v</dd></dl></div>"
    frame = spark.createDataFrame([(1, "be", text), (2, "nl", None), (3, "be", "<p>")], "page_id long, host string, body string")
    frame.createOrReplaceTempView("tf_pages")
    return frame


def test_table_functions(spark, pages):
    one = lambda sql: [tuple(r) for r in spark.sql(sql).collect()]
    assert one("SELECT * FROM html_rows(TABLE(tf_pages), 'body')") == [(1, "be", 0, 0, ["x", "m"], ["/m"])]
    assert one("SELECT page_id, href FROM html_anchors(TABLE(SELECT page_id, body FROM tf_pages), 'body') ORDER BY pos") == [(1, "/m"), (1, "/c")]
    assert one("SELECT value, label FROM html_options(TABLE(tf_pages) PARTITION BY (host), 'body', 'o')") == [("1", "One")]
    assert one("SELECT title, link, fields FROM html_cards(TABLE(tf_pages), 'body', 'card')") == [("C", "/c", {"k": "v"})]
    assert one("SELECT tag, value, text FROM html_elements(TABLE(tf_pages), 'body', 'h2, h3', 'id') ORDER BY pos") == [("h2", "a", "T"), ("h3", None, "C")]
    assert spark.sql("SELECT * FROM html_rows(TABLE(tf_pages), 'body')").columns == ["page_id", "host", "table_no", "row_no", "cells", "links"]


def test_what_table_functions_reject(spark, pages):
    for call, said in (("html_rows(TABLE(tf_pages), 'none')", "names a column"), ("html_rows(TABLE(tf_pages), 'body', 'x')", "0 constant strings"), ("html_options(TABLE(tf_pages), 'body')", "1 constant strings"), ("html_rows('x', 'body')", "is a table"), ("html_anchors(TABLE(SELECT 1 AS pos, '' AS body), 'body')", "same names")):
        with pytest.raises(Exception, match=said):
            spark.sql(f"SELECT * FROM {call}").collect()


def test_rows_are_handed_on_one_by_one():
    many = "<table>" + "<tr><td>x</td></tr>" * 3 + "</table>"
    found = html.rows_of(many)
    assert next(found) == (0, 0, ["x"], []) and next(found)[1] == 1
    assert [r[:2] for r in html.rows_of("<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table><table><tr></tr><tr><td>c</td></tr></table>")] == [(0, 0), (1, 0), (2, 1)]


def test_containers_say_nothing_themselves(spark):
    flow = html.flow(spark.createDataFrame([(1, "<div><ul><li>a <b>x</b></li></ul></div>")], "k int, html string"), "html", ["k"])
    assert [(r["tag"], r["text"]) for r in flow.orderBy("pos").collect()] == [("div", ""), ("ul", ""), ("li", "a x"), ("b", "x")]


def test_line_numbers_over_several_splits(spark, tmp_path):
    lines = [f"name {i};https://h.be/{'x' * (i % 40)}" if i % 9 else "" for i in range(3000)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("\n".join(["entity;url", *lines]) + "\n")
    (tmp_path / "a" / "two.csv").write_bytes("\r\n".join(["entity", "x;https://x.be"]).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        found = catalogue.numbered(spark, str(tmp_path / "a"))
        splits = spark.read.text(str(tmp_path / "a")).select("_metadata.file_block_start").distinct().count()
        for most in (100_000, 0):
            rows = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["line"] for r in catalogue.numbered(spark, str(tmp_path / "a"), most).collect()}
            want = {("one.csv", i + 2): x for i, x in enumerate(lines) if x} | {("one.csv", 1): "entity;url", ("two.csv", 1): "entity", ("two.csv", 2): "x;https://x.be"}
            assert splits > 10 and rows == want and found.count() == len(want)
        out = {(r["file"].rsplit("/", 1)[1], r["line_no"]): (r["entity"], r["reason"]) for r in catalogue.audit_scan(spark, str(tmp_path / "a")).collect()}
        assert out[("two.csv", 2)] == ("x", "no header") and out[("one.csv", 3)] == ("name 1", None) and len(out) == len(want) - 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_audit_keeps_invalid_urls_and_says_why_rows_go(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('Entity;URL\nA;ftp://a\n;https://b.be\nonly\n"C;c";https://c.be;more\nD;\n')
    out = [(r["line_no"], r["entity"], r["url"], r["reason"]) for r in catalogue.audit_scan(spark, str(path)).orderBy("line_no").collect()]
    assert out == [(2, "A", "ftp://a", None), (3, "", "https://b.be", "no name"), (4, "only", "", "fewer than two fields"), (5, "C;c", "https://c.be", None), (6, "D", "", None)]
    (tmp_path / "one.csv").write_text("entity\nA;https://a.be\n")
    assert catalogue.read_catalogue(spark, str(tmp_path / "one.csv")).count() == 0 and catalogue.read_catalogue(spark, str(path)).count() == 5


def test_first_match_equals_each_against_all(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abAB c") for _ in range(rng.randrange(n)))
    organs, terms = [(i, word(9)) for i in range(150)] + [(900, None), (901, "İstanbul")], [(word(7),) for _ in range(120)] + [(None,), ("",), ("ab",), ("zz",)]
    o, t = spark.createDataFrame(organs, "id int, name string"), spark.createDataFrame(terms, "term string").distinct()
    for two_way in (True, False):
        for drop_empty in (True, False):
            kept = [(i, n) for i, n in organs if n or not drop_empty]

            def meets(n, x, two_way=two_way):
                return n is not None and x is not None and (x.lower() in n.lower() or (two_way and n.lower() in x.lower()))

            want = {x: min(((i, n) for i, n in kept if meets(n, x)), default=(0, x))[1] for (x,) in set(terms)}
            out = lookups.first_match(t, o.filter("name <> ''") if drop_empty else o, "term", "name", "id", two_way)
            assert {r["term"]: r["resolved"] for r in out.collect()} == want
    plan = lookups.contained(t, "term", o.withColumnRenamed("name", "n"), "n")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_names_and_terms(spark):
    o = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("Raad van "), F.hex(F.col("id") * 7919)).alias("name"))
    t = spark.range(2_000).select(F.hex(F.col("id") * 10 * 7919).alias("term"))
    out = lookups.first_match(t, o, "term", "name", "id", two_way=False)
    assert out.filter(~F.contains("resolved", "term")).count() == 0 and out.filter("resolved like 'Raad van %'").count() == 2_000


def test_sites_by_part_of_their_host(spark):
    links = spark.createDataFrame([("www.raad.gent.be", "/pv/1"), ("gent.be", "/pv/2"), ("brugge.be", "/x"), (None, "/pv/3")], "host string, link string")
    sites = spark.createDataFrame([("gent.be", "Gent", "/pv/"), ("raad.gent", "Raad", "1$"), ("brugge", "Brugge", "/pv/")], "host string, name string, pattern string")
    assert sorted((r["link"], r["name"]) for r in scans.for_sites(links, sites, within=True).collect()) == [("/pv/1", "Raad"), ("/pv/2", "Gent")]


def test_marks_of_all_scripts(spark):
    texts = [chr(c) for c in range(0xA0, 0x2000) if chr(c).isalpha()] + ["ẹ́", "ŽELEZNÝ-Brod", "Ά ὰ", "ộ"]
    out = spark.createDataFrame([(x,) for x in texts], "t string").select("t", names.without_marks(F.col("t")).alias("bare")).collect()
    for r in out:
        want = "".join(c for c in unicodedata.normalize("NFD", r["t"]) if unicodedata.category(c) != "Mn")
        assert unicodedata.normalize("NFC", r["bare"]) == unicodedata.normalize("NFC", want), r["t"]
    rows = spark.createDataFrame([("Žeľo", 1), ("ZELO", 2), ("zélō", 3), ("zel", 4)], "n string, k int")
    assert sorted(r["count"] for r in rows.groupBy(names.alike(F.col("n")).alias("n")).count().collect()) == [1, 3]
    joined = rows.alias("a").join(rows.alias("b"), names.alike(F.col("a.n")) == names.alike(F.col("b.n")))
    assert joined.count() == 10


def results(spark, n):
    return spark.range(n).select("id", (F.col("id") % 5 != 0).alias("success"), (F.col("id") % 3 == 0).alias("skipped"))


def test_a_batch_job_counts_what_it_writes(spark, tmp_path):
    out = str(tmp_path / "out")
    counts = watch.counted(results(spark, 100), lambda df: df.write.parquet(out))
    want = reports.outcomes(spark.read.parquet(out), [], F.col("success"), F.col("skipped")).head().asDict()
    assert counts == want and counts["total"] == 100


def test_a_listener_hears_every_batch_once(spark, tmp_path):
    source, out, check, heard = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), []
    results(spark, 90).repartition(3).write.parquet(source)

    def run():
        stream = spark.readStream.schema("id long, success boolean, skipped boolean").option("maxFilesPerTrigger", 1).parquet(source)
        watch.watched(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()

    totals = watch.listening(spark, run, lambda number, own, sums: heard.append((number, own["total"], sums["total"])))
    assert totals == reports.outcomes(spark.read.parquet(out), [], F.col("success"), F.col("skipped")).head().asDict()
    assert [h[0] for h in heard] == [0, 1, 2] and heard[-1][2] == 90 and sum(h[1] for h in heard) == 90
    assert watch.listening(spark, run)["total"] == 0  # a restart has nothing new to tell
