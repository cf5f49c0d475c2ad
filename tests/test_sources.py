"""HTML extraction, fetching, sinks and streaming on fixtures."""

import json

from pyspark.sql import functions as F

from gavel.operators import sinks
from gavel.sources import fetch, html
from gavel.streaming import incremental


def pages(spark, text):
    return spark.createDataFrame([(1, text)], "k int, html string")


def test_anchors(spark):
    found = html.anchors(pages(spark, '<p><a href="/a.pdf">A <b>x</b></a><a name="n">no</a><script>"<a href=q>"</script><a href="b?x=1&amp;y=2"></a>'), "html", ["k"])
    assert [(r["pos"], r["href"], r["label"]) for r in found.orderBy("pos").collect()] == [(0, "/a.pdf", "A x"), (1, "b?x=1&y=2", "")]


def test_rows_and_options(spark):
    text = "<table><tr><th>h</th></tr><tr><td>GR</td><td><a href='/m'>01/02/2025</a></td></tr><tr><td>x</td></tr></table><select name=o><option value=''>-</option><option value=u1>Raad</option></select><option value=z>out</option>"
    rows = html.table_rows(pages(spark, text), "html", ["k"]).orderBy("row_no").collect()
    assert [(r["table_no"], r["row_no"], r["cells"], r["links"]) for r in rows] == [(0, 1, ["GR", "01/02/2025"], ["/m"]), (0, 2, ["x"], [])]
    assert [(r["value"], r["label"]) for r in html.options(pages(spark, text), "html", ["k"], "o").collect()] == [("u1", "Raad")]


def test_cards(spark):
    text = "<div class='item card'><h3>T</h3><time datetime='2025-01-02T00:00:00Z'></time><a href='/d.pdf'>d</a><dl><dt>Nr</dt><dd>7</dd></dl></div><div class=card><h3>U</h3></div>"
    rows = html.cards(pages(spark, text), "html", ["k"], "card").orderBy("pos").collect()
    assert [(r["title"], r["link"], r["day"], r["fields"]) for r in rows] == [("T", "/d.pdf", "2025-01-02T00:00:00Z", {"Nr": "7"}), ("U", None, None, {})]


def test_null_and_broken_pages(spark):
    assert html.anchors(spark.createDataFrame([(1, None), (2, "<a href='x'")], "k int, html string"), "html", ["k"]).count() == 0


def test_retry_then_success():
    calls, pauses = [], []

    def ask(url):
        calls.append(url)
        if len(calls) == 1:
            raise TimeoutError("timed out")
        return 200, {}, "ok"

    assert fetch.fetch("https://x.be", ask, delay=1.0, sleep=pauses.append)[:3] == (200, {}, "ok")
    assert (len(calls), pauses) == (2, [1.0])


def test_gives_up():
    pauses = []

    def ask(url):
        raise ConnectionRefusedError("refused")

    assert fetch.fetch("https://x.be", ask, sleep=pauses.append) == (None, {}, "", "refused")
    assert pauses == [1.5, 3.0]
    assert fetch.fetch("ftp://x")[3] == "invalid URL"


def test_page_source(spark):
    fetch.register(spark)
    urls = ["https://a.be/1", "https://a.be/fails", "https://b.be/busy", "https://b.be/gone"]
    options = {"urls": json.dumps(urls), "transport": "transports:canned", "spacing": "0", "delay": "0"}
    rows = {r["url"]: (r["status"], r["error"]) for r in spark.read.format("gavel-pages").options(**options).load().collect()}
    assert rows == {urls[0]: (200, None), urls[1]: (None, "timeout"), urls[2]: (503, "HTTP 503"), urls[3]: (404, "HTTP 404")}


def test_sink_outcomes(spark):
    schema = "url string, hint string, disposition string, content_type string, status int, body string"
    rows = [("https://x.be/a.pdf", None, None, "application/pdf", 200, "%PDF-1"), ("https://x.be/old.pdf", None, None, "application/pdf", 200, "%PDF"), ("https://x.be/p", None, None, "text/html", 200, "<html>"), ("https://x.be/b", None, None, "application/pdf", 200, ""), ("https://x.be/c.pdf", None, None, "application/pdf", 200, "<html>"), ("https://x.be/d.pdf", None, None, None, 500, None), ("/rel", None, None, None, 200, "%PDF")]
    manifest = spark.createDataFrame([("old.pdf",)], "file string")
    out = {r["url"]: (r["file"], r["success"], r["skipped"], r["error"]) for r in sinks.stored(spark.createDataFrame(rows, schema), manifest).collect()}
    assert out["https://x.be/a.pdf"] == ("a.pdf", True, False, None)
    assert out["https://x.be/old.pdf"] == ("old.pdf", True, True, None)
    assert out["https://x.be/p"][3] == "page instead of document"
    assert out["https://x.be/b"] == ("b.pdf", False, False, "empty")
    assert out["https://x.be/c.pdf"][3] == "no PDF"
    assert out["https://x.be/d.pdf"][3] == "HTTP 500"
    assert out["/rel"][3] == "invalid URL"


def test_incremental_stream(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (docs.filter("doc_id < 100"), docs.filter("doc_id >= 50")):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
        stream = incremental.read_table(spark, folder, "documents")
        incremental.harvest_stream(stream, out, str(tmp_path / "check"), "doc_id", "source").awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == stored.select("doc_id").distinct().count() == docs.count()


def test_stream_dedup(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(str(tmp_path / "in" / "events.parquet"))
    stream = incremental.seen_once(incremental.read_table(spark, str(tmp_path / "in"), "events"), "user_id", "ts", "100 days")
    query = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "check")).start()
    query.awaitTermination()
    assert spark.table("once").count() == spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct().count()


def test_write_by_entity(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "entity string, n int")
    sinks.write_by_entity(rows, str(tmp_path / "j"), ["entity"])
    assert spark.read.json(str(tmp_path / "j")).filter(F.col("entity") == "b").select("n").head()["n"] == 2


def test_bodies_are_stored_once(spark, tmp_path):
    schema = "url string, hint string, disposition string, content_type string, status int, body string"
    row = lambda name, status=200, body="%PDF-1.4": (f"https://a.be/{name}", name, None, "application/pdf", status, body)
    path = str(tmp_path / "bodies")
    batches = [[row("a.pdf"), row("b.pdf", 404, ""), row("c.pdf", 200, "<html>")], [row("a.pdf"), row("b.pdf"), row("c.pdf", 200, None)]]
    seen = []
    for batch in batches:
        judged = sinks.stored(spark.createDataFrame(batch, schema), sinks.manifest(spark, path))
        seen.append({r["hint"]: (r["success"], r["skipped"]) for r in judged.collect()})
        sinks.save_bodies(judged, path)
    assert seen[0] == {"a.pdf": (True, False), "b.pdf": (False, False), "c.pdf": (False, False)}
    assert seen[1] == {"a.pdf": (True, True), "b.pdf": (True, False), "c.pdf": (False, False)}
    assert sorted((r["file"], r["body"]) for r in spark.read.parquet(path).collect()) == [("a.pdf", "%PDF-1.4"), ("b.pdf", "%PDF-1.4")]
