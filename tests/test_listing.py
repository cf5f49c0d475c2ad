"""Paged and streamed listings over injected transports, and documents as files."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gavel.operators import sinks
from gavel.sources import files, listing

PORTAL = {"transport": "transports:portal", "spacing": "0", "delay": "0"}
NUMBERS = {"protocol": "page", "parameter": "page", "look": "gavel.sources.listing:html_page"}


def pages(spark, listings, **options):
    listing.register(spark)
    given = {k: str(v) for k, v in (PORTAL | options).items()}
    return spark.read.format("gavel-listing").options(listings=json.dumps(listings), **given).load()


def walked(url, **options):
    return list(listing.walk(url, listing.Cursor.of(PORTAL | options)))


def test_three_hosts_of_uneven_page_counts(spark):
    rows = pages(spark, ["https://p1.be/next", "https://p3.be/next", "https://p7.be/next"]).collect()
    assert {h: sorted(r["page"] for r in rows if h in r["listing"]) for h in ("p1", "p3", "p7")} == {"p1": [0], "p3": [0, 1, 2], "p7": list(range(7))}
    assert all(r["error"] is None and len(json.loads(r["body"])["data"]) == 5 for r in rows)
    first = next(r for r in rows if r["listing"] == "https://p7.be/next" and r["page"] == 1)
    assert (first["newest"], first["oldest"]) == (date(2024, 12, 21), date(2024, 12, 13))


def test_the_start_date_is_read_off_the_filter(spark):
    rows = pages(spark, ["https://p9.be/next"], since_parameter="since").filter(F.col("newest") >= F.lit("2024-12-20").cast("date")).select("page", "url").collect()
    assert sorted((r["page"], r["url"].endswith("since=2024-12-20")) for r in rows) == [(0, True), (1, True)]
    plan = pages(spark, ["https://p9.be/next"]).filter("newest >= DATE '2024-12-20'")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan


def test_where_a_cursor_stops():
    assert [r[1] for r in walked("https://p9.be/next", since="2024-12-15")] == [0, 1]  # the second page has older ones
    assert [r[1] for r in walked("https://p9.be/numbers", **NUMBERS)] == list(range(9))  # until there is no such page
    assert [r[1] for r in walked("https://p9.be/mixed", since="2024-12-15", **NUMBERS)] == [0, 1]
    assert [r[1] for r in walked("https://p9.be/mixed", since="2024-12-15", stop="all", **NUMBERS)] == list(range(9))
    offsets = walked("https://p3.be/numbers", protocol="offset", parameter="start", step="5", look=NUMBERS["look"])
    assert [r[2].rpartition("=")[2] for r in offsets] == ["0", "5", "10"]
    assert [r[1] for r in walked("https://p0.be/next")] == [0]  # a listing without items is a page without items
    honest = walked("https://p9.be/honest", since="2024-12-27", since_parameter="since")
    assert [len(json.loads(r[6])["data"]) for r in honest] == [3, 0][: len(honest)]


def test_a_listing_is_never_cut_short_without_a_word():
    assert [(r[1], r[7]) for r in walked("https://p5.be/stuck")] == [(0, None), (1, "repeats the page before")]
    assert [(r[1], r[7]) for r in walked("https://p5.be/broken")] == [(0, None), (1, None), (2, "refused")]
    assert [r[7] for r in walked("https://p5.be/next", limit="2")] == [None, None, "more than 2 pages"]
    assert walked("ftp://p5.be/next")[0][7] == "invalid URL"
    for wrong in ({"protocol": "guess"}, {"stop": "never"}):
        with pytest.raises(ValueError, match="one of"):
            listing.Cursor.of(wrong)


def test_looks_and_days():
    assert listing.json_page("no json") == listing.json_page("[1]") == listing.json_page("{}") == listing.Seen(0)
    assert listing.json_page('{"items": [{"date": "2024-02-30"}, {"date": "2024-02-29"}], "next": "/b"}') == listing.Seen(2, [date(2024, 2, 29)], "/b")
    assert listing.html_page('<a rel="next" href="/2">more</a><a href="/x">op 3.4.2025</a><a>none</a>') == listing.Seen(1, [date(2025, 4, 3)], "/2")
    assert listing.day_of("31/02/2024") is None


def test_follow_takes_listings_from_a_table(spark):
    table = spark.createDataFrame([("https://p2.be/next",), ("https://p4.be/next",), ("https://p2.be/next",), (None,)], "at string")
    found = listing.follow(table, listing.Cursor.of(PORTAL), "at")
    assert sorted((r["listing"], r["page"]) for r in found.collect()) == [("https://p2.be/next", k) for k in range(2)] + [("https://p4.be/next", k) for k in range(4)]
    assert listing.follow(table.limit(0), listing.Cursor.of(PORTAL), "at").count() == 0


def test_requests_are_spaced(monkeypatch):
    slept, now = [], [100.0]
    monkeypatch.setattr(listing.time, "sleep", lambda s: (slept.append(round(s, 3)), now.__setitem__(0, now[0] + s)))
    monkeypatch.setattr(listing.time, "monotonic", lambda: now[0])
    wait = listing.Spaced(0.2)
    wait()
    now[0] += 0.05
    wait()
    now[0] += 5
    wait()
    assert slept == [0.15, 0.0]


def stream(spark, **options):
    listing.register(spark)
    given = PORTAL | {"listings": json.dumps([f"https://p{h}.be/calendar/{{month}}" for h in (1, 2)]), "from": "2023-11", "until": "2024-04", "requests": "2"} | options
    return spark.readStream.format("gavel-listing").options(**given).load().select("listing", "body")


def test_a_restart_repeats_and_loses_nothing(spark, tmp_path):
    out, check, sizes = str(tmp_path / "out"), str(tmp_path / "check"), []
    for _ in range(5):
        run = stream(spark).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        run.awaitTermination()
        sizes.append(spark.read.parquet(out).count())
    assert sizes == [4, 8, 12, 12, 12]  # two months of two hosts a run
    months = [f"{m}" for m in (202311, 202312, 202401, 202402, 202403, 202404)]
    assert sorted(r["listing"] for r in spark.read.parquet(out).collect()) == sorted(f"https://p{h}.be/calendar/{m}" for h in (1, 2) for m in months)


def test_a_batch_that_failed_is_read_again(spark, tmp_path):
    out, check, failed = str(tmp_path / "out"), str(tmp_path / "check"), []

    def store(batch, number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("stopped between batches")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for _ in range(4):
        run = stream(spark).writeStream.foreachBatch(store).option("checkpointLocation", check).trigger(availableNow=True).start()
        try:
            run.awaitTermination()
        except Exception as e:  # noqa: BLE001
            assert "stopped between batches" in str(e)
    rows = spark.read.parquet(out)
    assert failed and rows.count() == rows.select("listing").distinct().count() == 12


def test_a_running_stream_admits_so_many_requests_a_trigger(spark):
    run = stream(spark, requests="1").writeStream.format("memory").queryName("months").start()
    run.processAllAvailable()
    assert spark.table("months").count() == 12
    assert max(p["numInputRows"] for p in run.recentProgress) == 2  # one a host
    run.stop()


def rows(spark, *pairs):
    files.register(spark)
    return spark.createDataFrame(list(pairs), "file string, body string").repartition(3)


def below(path):
    return {str(p.relative_to(path)): p.read_text() for p in sorted(Path(path).rglob("*")) if p.is_file()}


def save(df, path, **options):
    df.write.format("gavel-files").options(path=str(path), **options).mode("append").save()


def test_files_are_written_once(spark, tmp_path):
    save(rows(spark, ("a/1.txt", "one"), ("a/b/2.txt", "zwéi"), ("3.txt", None)), tmp_path / "x")
    save(rows(spark, ("a/1.txt", "changed"), ("4.txt", "four")), tmp_path / "x")
    assert below(tmp_path / "x") == {"a/1.txt": "one", "a/b/2.txt": "zwéi", "3.txt": "", "4.txt": "four"}
    save(rows(spark, ("a/1.txt", "changed")), tmp_path / "x", existing="replace")
    assert below(tmp_path / "x")["a/1.txt"] == "changed"
    assert {(r["file"], r["bytes"]) for r in sinks.files_below(spark, str(tmp_path / "x")).collect()} == {("a/1.txt", 7), ("a/b/2.txt", 5), ("4.txt", 4)}  # empty ones are not listed
    save(rows(spark).limit(0), tmp_path / "y")
    assert sinks.files_below(spark, str(tmp_path / "z")).count() == 0


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    for wrong in ("../out.txt", "/etc/out.txt", "", "a/./b", "_staging/x"):
        good = [(f"{i}.txt", "x") for i in range(20)]
        with pytest.raises(Exception, match="not a file name"):
            save(rows(spark, *good, (wrong, "y")), tmp_path / "x")
        assert below(tmp_path / "x") == {} and not (tmp_path / "out.txt").exists()
    save(rows(spark, ("1.txt", "x")), tmp_path / "x")
    with pytest.raises(Exception, match="1.txt"):
        save(rows(spark, ("1.txt", "y"), ("2.txt", "y")), tmp_path / "x", existing="error")
    assert below(tmp_path / "x") == {"1.txt": "x"}


def test_policies_of_sinks(spark, tmp_path):
    schema = "url string, hint string, disposition string, content_type string, status int, body string"
    row = lambda name, body, status=200: (f"https://a.be/{name}", name, None, "application/pdf", status, body)
    docs = spark.createDataFrame([row("big", "x" * 200), row("small.pdf", "x" * 99), row("there.pdf", "y" * 200), row("gone.pdf", "", 404)], schema)
    there = spark.createDataFrame([("there.pdf",)], "file string")
    judged = {r["file"]: (r["success"], r["skipped"], r["error"]) for r in sinks.stored(docs, there, sinks.LEGACY_PDF).collect()}
    assert judged == {"big.pdf": (True, False, None), "small.pdf": (False, False, "empty"), "there.pdf": (False, True, "exists"), "gone.pdf": (False, False, "HTTP 404")}
    judged = {r["file"]: r["success"] for r in sinks.stored(docs, there, sinks.LEGACY_ANY).collect()}
    assert judged == {"big.pdf": True, "small.pdf": True, "there.pdf": True, "gone.pdf": False}
    held = spark.createDataFrame([("besluit 1", "<p>x</p>", None), ("b2.html", "", "https://a.be/2"), ("none", None, None)], "name string, content string, url string")
    inline = sinks.stored(sinks.inline_documents(held, "name", "content"), there, sinks.INLINE)
    sinks.write_files(inline, str(tmp_path / "inline"))
    assert below(tmp_path / "inline") == {"besluit 1.html": "<p>x</p>"}


def test_a_mirror_answers_for_a_site(spark, tmp_path):
    save(rows(spark, ("a.be/index", "home"), ("a.be/x?page=2", "two")), tmp_path)
    ask = files.mirror(str(tmp_path))
    assert ask("https://a.be/") == (200, {"Content-Type": "text/html"}, "home")
    assert ask("https://a.be/x?page=2#top")[2] == "two" and ask("https://a.be/x")[0] == 404 and ask("https://a.be/", method="HEAD") == (200, {}, "")


def test_probes(spark):
    urls = spark.createDataFrame([("https://a.be/x",), ("https://a.be/gone",), ("https://b.be/fails",), ("ftp://c",), (None,), ("https://a.be/x",)], "url string")
    found = {r["url"]: (r["status"], r["error"]) for r in listing.probes(urls, transport="transports:canned", spacing=0.0).collect()}
    assert found == {"https://a.be/x": (200, None), "https://a.be/gone": (404, None), "https://b.be/fails": (None, "timeout"), "ftp://c": (None, "invalid URL")}
