"""What the third round's findings named, on small tables that show it."""

import random
import time
import tracemalloc
from datetime import date, datetime
from uuid import uuid4

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from gavel.catalogue_queries import ORACLE, QUERIES
from gavel import session
from gavel.operators import crawl, scans, sinks
from gavel.plans import listing as plans
from gavel.sources import files, html, listing


def differs(spark, folder, name, **tables):
    """What a query on small tables (lists of rows, schema) gives otherwise than its SQL."""
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return difference(QUERIES[name](spark, str(folder)), ORACLE[name], connect(str(folder)))


ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"


def test_names_of_one_key_do_not_meet_in_pairs(spark, tmp_path):
    rows = [(k, k % 25) for k in range(1, 3001)]
    assert differs(spark, tmp_path, "accent_fold_join", customer=(rows, "c_custkey long, c_nationkey int")) == ""
    spark.catalog.clearCache()
    plan = QUERIES["accent_fold_join"](spark, str(tmp_path))
    other = spark.read.parquet(f"{tmp_path}/customer.parquet").count()
    assert plan.count() == other
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner") < text.rindex("Aggregate [key")  # one side of the join has a row a key


def test_folders_below_numbers_like_years(spark, tmp_path):
    links = spark.createDataFrame([(1, 0, "/c/2050/1999"), (1, 1, "/c/1995/2003"), (1, 2, "/c/1995/x")], "k int, pos long, link string")
    kept = crawl.subfolders(links, links.select("k", "link").limit(0), ["k"], r"/\d{4}$", "year", since=2002)
    assert [r["link"] for r in kept.collect()] == ["/c/1995/2003"]
    rows = [(k, 1990 + k % 70, datetime(1992 + k % 7, 3, 1)) for k in range(1, 600)]
    assert differs(spark, tmp_path, "crawl_subfolders", orders=(rows, ORDERS)) == ""


def test_least_sizes_are_bytes(spark, tmp_path):
    texts = ["é" * 49 + "x", "é" * 50, "é" * 99, "x" * 99, "x" * 100, "€" * 33, "€" * 34]
    rows = [(5 * i + 4, x, "web", "nl", len(x)) for i, x in enumerate(texts)]
    assert differs(spark, tmp_path, "files_written", documents=(rows, "doc_id long, text string, source string, lang string, n_chars long")) == ""
    body = spark.createDataFrame([("a", "é" * 50)], "hint string, body string").withColumns({"disposition": F.lit(None).cast("string"), "url": F.lit("https://x.be/a"), "content_type": F.lit("application/pdf"), "status": F.lit(200)})
    none = spark.createDataFrame([], "file string")
    assert [r["error"] for r in sinks.stored(body, none, sinks.LEGACY_PDF).collect()] == [None]


def test_seconds_before_midnight_are_rounded(spark, tmp_path):
    rows = [(k, datetime(2024, 1, 5, 23, 59, 59, micro)) for k, micro in enumerate([0, 400000, 499999, 500000, 500001, 999999])] + [(9, datetime(2024, 1, 5, 23, 59, 58, 500000)), (10, datetime(1969, 12, 31, 23, 59, 59, 700000))]
    assert differs(spark, tmp_path, "meeting_labels", events=(rows, "event_id long, ts timestamp_ntz")) == ""


@pytest.mark.parametrize("year", [1992, 1993, 1998])
def test_years_of_both_centuries_are_listed(spark, tmp_path, year):
    rows = [(1, 7, datetime(year, 3, 1)), (2, 7, datetime(year, 4, 1))]
    assert differs(spark, tmp_path, "scan_year_list", orders=(rows, ORDERS)) == ""
    assert [(r["o_custkey"], r["year"]) for r in QUERIES["scan_year_list"](spark, str(tmp_path)).collect()] == [(7, date(year, 1, 1).year + 6)]


def test_listings_of_one_host_are_read_by_many_tasks(spark, tmp_path):
    """Without spacing nothing holds a host's listings together; with it they stay in one task."""
    urls = spark.range(200).select(F.concat(F.lit("https://h.be/u/"), "id").alias("listing"))
    tasks = lambda spacing, transport: listing._dealt(urls, "listing", "listing", 8, transport, spacing).select(F.spark_partition_id()).distinct().count()
    assert (tasks(0.2, "x:y"), tasks(0.0, "x:y"), tasks(0.0, "packs:8:/x") > 3) == (1, 8, True)


def test_packs_answer_for_a_site(spark, tmp_path):
    pages = spark.createDataFrame([("https://a.be/u/1", "{}"), ("https://a.be/u/1?page=1", "two"), ("https://a.be/é", None), ("http://a.be/u/12", "<p>")], "url string, body string")
    files.write_packs(pages, str(tmp_path / "p"), 5)
    ask = listing.named(f"packs:5:{tmp_path / 'p'}")
    assert ask("https://a.be/u/1#x") == (200, {"Content-Type": "application/json"}, "{}")
    assert ask("https://a.be/u/1?page=1")[2] == "two" and ask("https://a.be/u/1?page=2")[0] == 404 and ask("https://a.be/none")[0] == 404
    assert ask("https://a.be/é")[::2] == (200, "") and ask("http://a.be/u/12", method="HEAD")[::2] == (200, "")


def test_paged_listings_write_no_file_a_page(spark, tmp_path, monkeypatch):
    rows = [(k, k % 9, datetime(1992 + k % 7, 3, 1 + k % 28)) for k in range(1, 400)]
    shared = tmp_path / "shared"
    monkeypatch.setattr(plans, "scratch", lambda spark, label: f"{shared}/{label}-{uuid4().hex}")
    for name in ("paged_meetings", "paged_requests"):
        assert differs(spark, tmp_path, name, orders=(rows, ORDERS)) == ""
    assert not list(shared.glob("mirror-*")) and len(list(shared.glob("packs-*"))) == 2


def test_requests_without_spacing_wait_for_nothing(spark, tmp_path, monkeypatch):
    """Packs are dealt one a task, and a listing's requests can be counted without passing its pages on."""
    monkeypatch.setattr(listing.time, "sleep", lambda seconds: pytest.fail(f"slept {seconds}"))
    pause = listing.Spaced(0.0)
    pause(), pause()
    monkeypatch.undo()
    pages = spark.range(300).select(F.concat(F.lit("https://h.be/u/"), "id").alias("url"), F.lit('{"data": [{"planned": "2024-02-30"}, {"planned": "2024-02-29T10:00"}]}').alias("body"))
    files.write_packs(pages, str(tmp_path / "p"), 24)
    assert len(list(tmp_path.glob("p/pack=*/*.parquet"))) == 24
    cursor = listing.Cursor(transport=f"packs:24:{tmp_path / 'p'}", spacing=0.0)
    dealt = listing._dealt(pages, "url", "listing", 4, cursor.transport, 0.0)
    assert dealt.select(F.spark_partition_id()).distinct().count() == 24
    whole, bare = listing.follow(pages, cursor, "url"), listing.follow(pages, cursor, "url", bodies=False)
    assert "body" not in bare.columns and bare.exceptAll(whole.drop("body")).count() == 0 and whole.filter("body is not null and oldest = date'2024-02-29'").count() == bare.count() == 300


PIECES = ["<a>", '<a href="/x?a=1&amp;b=2">', "</a>", "<p>", "</p>", "<table>", "<tr>", "<td>", "</td>", "</tr>", "</table>", "<br>", "<br/>", "<li>", "</li>", "a", " b ", "&amp;", "&eacute;", "&lt", "x > y", "<", "< p", "<!-- c -->", "<!doctype html>", "<B>", "<p class=x>", '<p id="1" id="2">', "<p id='q'>", '<p hidden>', "<script>1<2</script>", "<style>", "</style>", "<title>t<b></title>", "</", "<a", '<p title="a>b">', '<p title="a<b">', "</p >", '</p class="x">', '<p x="&copy=1">', '<p x="&#39;">', "<textarea>", "\n", "é", "<h2>", "</h2>", '<i a="1"b="2">', "<?x?>", "&", "<p\tid=\"1\">"]


def by_parser(page):
    collector = html._Collector()
    collector.feed(page)
    collector.close()
    return collector.elements()


def test_plain_pages_give_what_the_parser_gives():
    rng, plain = random.Random(5), 0
    for n in range(30000):
        page = "".join(rng.choice(PIECES[:20] if n % 2 else PIECES) for _ in range(rng.randrange(14)))
        plain += html._plain(page) is not None
        assert html.parsed(page) == by_parser(page), page
    assert plain > 5000


def test_elements_know_what_lies_inside_them():
    """The position of the last element inside, told while a page is read, is what depths say; by pattern and by parser."""
    rng, nested = random.Random(6), 0
    for n in range(10000):
        page = "".join(rng.choice(PIECES[:20] if n % 2 else PIECES) for _ in range(rng.randrange(14)))
        found, last, open_ = html._read(page)[0], [], []
        for i, e in enumerate(found):
            while open_ and found[open_[-1]][4] >= e[4]:
                open_.pop()
            open_.append(i)
            last.append(i)
            for j in open_:
                last[j] = i
        assert [e[5] for e in found] == last, page
        nested += any(k > i for i, k in enumerate(last))
    assert nested > 1000


def test_maps_are_laid_out_whole():
    values = ({"a": "1", "b": ""}, None, {}, {"a": "é"})
    assert html._array(values, "map<string,string>").to_pylist() == [[("a", "1"), ("b", "")], None, [], [("a", "é")]]


def test_cells_are_read_in_one_step_each():
    row = "<table><tr>" + "<td>word</td>" * 100 + "</tr></table>"
    assert len(html._PLAIN.findall(row)) == 104  # a start tag, its text and its end tag
    assert list(html.rows_of(row)) == [(0, 0, ["word"] * 100, [])]
    assert html.parsed("</p>x</p><br>y</br><p></p>z") == by_parser("</p>x</p><br>y</br><p></p>z")


def test_long_rows_are_read_in_proportion():
    page = "<table><tr>" + "<td>word</td>" * 400_000 + "</tr></table>"
    begun = time.process_time()
    assert len(next(iter(html.rows_of(page)))[2]) == 400_000
    assert time.process_time() - begun < 8  # texts that were added up cell by cell took minutes


def test_pages_are_passed_on_a_few_rows_at_a_time(spark, monkeypatch):
    """No batch is made of all that a batch of pages holds; keys of any type go with their rows."""
    monkeypatch.setattr(html, "TOGETHER", 7)
    pages = spark.createDataFrame([(k, date(2024, 1, 1 + k), "".join(f'<a href="/{k}/{j}">x</a>' for j in range(k))) for k in range(20)] + [(30, None, None)], "k int, d date, html string").coalesce(1)
    found = html.anchors(pages, "html", ["k", "d"])
    assert sorted((r["k"], r["d"].day - 1, r["pos"], r["href"]) for r in found.collect()) == sorted((k, k, j, f"/{k}/{j}") for k in range(20) for j in range(k))
    flow = html.flow(pages, "html", ["k"]).filter("k = 3").collect()
    assert [(r["attrs"], r["last"], r["text"]) for r in flow] == [({"href": f"/3/{j}"}, j, "x") for j in range(3)]


def test_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    """Where a table has more rows than the session's tasks can take, its groups, windows and joins have more tasks, and the same rows."""
    monkeypatch.setattr(session, "PER_TASK", 10)
    rows = spark.range(90).withColumn("k", F.col("id") % 40)
    assert session.spread(rows, 90, "k").rdd.getNumPartitions() == 9
    assert session.spread(rows, 9, "k").rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    orders = [(k, k % 9, datetime(1992 + k % 7, 3, 1 + k % 28)) for k in range(1, 200)]
    lines = [(k, k % 5, j) for k in range(1, 200) for j in range(1, 1 + k % 6)]
    tables = {"orders": (orders, ORDERS), "lineitem": (lines, "l_orderkey long, l_partkey long, l_linenumber int"), "part": ([(k, f"p{k}") for k in range(5)], "p_partkey long, p_name string")}
    for name in ("scan_date_first_rows", "scan_attribute_rows", "scan_item_cards", "scan_agenda_forms", "tree_expand"):
        assert differs(spark, tmp_path, name, **tables) == "", name


def test_agendas_of_both_forms_are_read_once(spark, tmp_path):
    lines = [(k, 1, j) for k in range(1, 60) for j in range(1, 1 + k % 6)]
    assert differs(spark, tmp_path, "scan_agenda_forms", lineitem=(lines, "l_orderkey long, l_partkey long, l_linenumber int")) == ""
    plan = QUERIES["scan_agenda_forms"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_agenda_items_are_those_of_their_two_forms(spark):
    pages = ["<h2>Agenda</h2><li>Punt een</li><li>xx</li><h2>Bijlagen</h2><li>na het einde</li>", "<b>Agenda</b><p>Eerste punt</p><p>kort</p><b>Bijlagen</b><p>Na het einde</p>", "<h2>Agenda</h2><p>Alleen tekst</p>", "<p>niets hier</p>", "<b>Bijlagen</b><b>Agenda</b><p>Derde punt</p>", "<h2>Bijlagen</h2><h2>Agenda</h2><li>Te laat hier</li>"]
    flow = html.flow(spark.createDataFrame(list(enumerate(pages)), "k int, html string"), "html", ["k"])
    listed = scans.items_under_heading(flow, ["k"], "agenda", "bijlagen")
    lines = scans.agenda_lines(flow.join(listed.select("k").distinct(), "k", "left_anti"), ["k"], "agenda", ["Bijlagen"])
    want = sorted(map(tuple, listed.unionByName(lines).collect()))
    assert sorted(map(tuple, scans.agenda_items(flow, ["k"], "agenda", ["Bijlagen"]).collect())) == want and len({w[0] for w in want}) == 5


PAGE = '<table class="x"><tr x-show="s"><a href="/early.pdf">0</a><th>01/02/2000</th><td><a href="/a.pdf">pdf</a><a href="/b.pdf">B</a></td></tr><tr><td>geen</td><td><span>s</span><a href="/c.pdf">C</a></td></tr></table>'


def test_a_flow_has_the_attributes_that_are_asked_for(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None)], "k int, html string")
    flow = html.flow(pages, "html", ["k"], attributes=("href",))
    assert {k for r in flow.collect() for k in r["attrs"]} == {"href"}
    strip = lambda df: sorted((r["pos"], r["last"], r["tag"], r["text"], r["attrs"].get("href")) for r in df.collect())
    assert strip(flow) == strip(html.flow(pages, "html", ["k"]))


def test_scans_shuffle_and_sort_only_what_they_look_at(spark, tmp_path):
    """Cells are numbered in the order of pages: one sort before rows are put together; maps are gone by then."""
    flow = html.flow(spark.createDataFrame([(1, PAGE)], "k int, html string"), "html", ["k"])
    numbered = scans.rows_of_tables(flow.filter("tag <> 'span'"), ["k"], ("td", "th"))
    assert [(r["tag"], r["row"], r["cell"]) for r in numbered.orderBy("pos").collect()] == [("tr", 1, 0), ("a", 1, 0), ("th", 1, 1), ("td", 1, 2), ("a", 1, 2), ("a", 1, 2), ("tr", 2, 0), ("td", 2, 1), ("td", 2, 2), ("a", 2, 2)]
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Sort [") == 1
    found = scans.date_first_rows(flow, ["k"], F.lit("1990-01-01").cast("date"))
    assert sorted((r["link"], r["name"]) for r in found.collect()) == [("/a.pdf", "a"), ("/b.pdf", "B"), ("/early.pdf", "0")]
    orders = [(k, k % 9, datetime(1992 + k % 7, 3, 1 + k % 28)) for k in range(1, 200)]
    for name in ("scan_positional_rows", "scan_first_link_of_heading", "scan_year_lists", "scan_inherited_dates", "semantic_agenda", "scan_classed_cards", "scan_item_cards"):
        assert differs(spark, tmp_path, name, orders=(orders, ORDERS)) == "", name


RUNS = ["</td><td>", "</td><td>", "</li><li>", "</br><br>", "</p><p>", *PIECES[:20], '<td id="1">']


def test_runs_of_cells_are_read_in_one_match():
    """Cells that follow each other and hold text only are one match of a page, at most 200 of them, and what the parser reads."""
    row = "<table><tr>" + "<td>w &amp; x</td>" * 1000 + "</tr></table>"
    assert len(html._RUNS.findall(row)) == 9  # two start tags, five runs and two end tags
    assert list(html.rows_of(row)) == [(0, 0, ["w & x"] * 1000, [])] and html.parsed(row) == by_parser(row)
    rng, runs = random.Random(7), 0
    for _ in range(30000):
        page = "".join(rng.choice(RUNS) for _ in range(rng.randrange(16)))
        runs += html._plain(page) is not None and "</td><td>" in page
        assert html.parsed(page) == by_parser(page), page
    assert runs > 3000


def test_what_is_said_is_not_cut_out_once_a_level():
    """Links, elements, options and cards of a deeply nested page take their own texts only, not those of all around them."""
    page = "<div>z" * 500 + "x" * 300_000 + '<p class="card"><h3>T</h3><a href="/x">y</a><select name="s"><option value="1">o</option></select></p>' + "</div>" * 500
    for read, want in ((html.anchors_of, [(0, "/x", "y")]), (lambda p: html.elements_of(p, ("h3",)), [(0, "h3", None, "T")]), (lambda p: html.options_of(p, "s"), [(0, "1", "o")]), (lambda p: html.cards_of(p, "card"), [(0, "T", "/x", None, {})])):
        tracemalloc.start()
        assert list(read(page)) == want
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 20 << 20  # 150 MB when the page's text was there once a level
