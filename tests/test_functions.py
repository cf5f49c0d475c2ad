"""Golden rows of names, URLs, dates and filters."""

import datetime

import pytest
from pyspark.sql import functions as F

from gavel.functions import dates, filters, names, urls
from gavel.operators import catalogue, lookups, ordered


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).head()["r"]


DATES = [
    ("cms_path", "GR20251216-Internet.pdf", "2025-12-16"),
    ("cms_path", "2025.02.17-PV.pdf", "2025-02-17"),
    ("cms_path", "Protokoll-Ratssitzung-18.12.2023.pdf", "2023-12-18"),
    ("cms_path", "pv-2025-01-27.pdf", "2025-01-27"),
    ("cms_path", "sitzungsprotokoll-gemeinderat-23122025-oeff.pdf", "2025-12-23"),
    ("cms_path", "/wp-content/uploads/2025/03/x.pdf", "2025-03-01"),
    ("cms_path", "pv-du-conseil-21-01-26.pdf", "2026-01-21"),
    ("cms_path", "pv-seance-cc-20-01-2025.pdf", "2025-01-20"),
    ("cms_path", "/seances-2025/08-decembre.pdf", "2025-12-08"),
    ("cms_path", "/seances-2025/1er-septembre.pdf", "2025-09-01"),
    ("cms_path", "/seances-2025/autre.pdf", "2025-01-01"),
    ("cms_path", "proces-verbal-27-janvier-2025-web.pdf", "2025-01-27"),
    ("cms_path", "/proces-verbaux/2025/20-janvier-2025/pv-x.pdf", "2025-01-20"),
    ("cms_path", "pvcc18122025.pdf", "2025-12-18"),
    ("cms_path", "26.02.09-PV.pdf", "2026-02-09"),
    ("cms_path", "x-20250230-2025.03.01.pdf", "2025-03-01"),
    ("cms_path", "verslag.pdf", None),
    ("cms_path", None, None),
    ("link_text", "du 03/03/26", "2026-03-03"),
    ("link_text", "Protokoll 13.01.2026", "2026-01-13"),
    ("link_text", "PV de la séance du 9 février 2026", "2026-02-09"),
    ("dutch_heading", "05 februari 2026", "2026-02-05"),
    ("dutch_heading", "x 05-02-2026", "2026-02-05"),
    ("dutch_heading", "op 5 februari 2026", None),
    ("dutch_url", "/notulen-gr-15-januari-2026", "2026-01-15"),
    ("dutch_url", "/a_20260202", "2026-02-02"),
    ("slug", "28052025", "2025-05-28"),
    ("slug", "28052025-0", "2025-05-28"),
    ("folder_label", "Council of 2025-01-29", "2025-01-29"),
    ("folder_label", "Council of 27-01-2016", "2016-01-27"),
    ("folder_label", "2025", None),
    ("french_du", "du 18 décembre 2025", "2025-12-18"),
    ("french_du", "de décembre 2024", "2024-12-01"),
]


@pytest.mark.parametrize(("rules", "text", "expected"), DATES)
def test_dates(spark, rules, text, expected):
    assert one(spark, text, lambda v: dates.parsed(v, rules).cast("string")) == expected


def test_date_fallback_year(spark):
    assert one(spark, "du 27 mars", lambda v: dates.du_with_fallback(v, F.lit(2025))) == datetime.date(2025, 3, 27)


@pytest.mark.parametrize(
    ("as_of", "n", "expected"),
    [("2026-03-26", 12, ("2025-03-19", "2025-03-31", "2025-03-26", "2026-01-01", "2026-01-01")), ("2026-03-31", 1, ("2026-02-28", "2026-03-01", "2026-02-28", "2026-03-01", "2026-02-01"))],
)
def test_cutoffs(spark, as_of, n, expected):
    modes = ("days31", "days30", "calendar", "clamped_next", "clamped")
    row = spark.range(1).select(*(dates.cutoff(F.lit(as_of).cast("date"), n, m).cast("string").alias(m) for m in modes)).head()
    assert tuple(row) == expected


@pytest.mark.parametrize(
    ("name", "expected"),
    [("../../../etc/passwd", "etc_passwd"), ("..\\..\\secret.txt", "secret.txt"), ("", "document"), (None, "document"), ("...", "document"), ("a<b>:c.pdf", "a_b_c.pdf"), ("CON.txt", "_CON.txt"), ("ﬁle.pdf", "file.pdf")],
)
def test_sanitise(spark, name, expected):
    assert one(spark, name, lambda v: names.sanitise(v, unicode=True)) == expected


def test_long_names_keep_extension(spark):
    out = one(spark, "a" * 300 + ".pdf", names.sanitise)
    assert len(out) == 180 and out.endswith("a.pdf")


def test_safe_path(spark):
    assert one(spark, "../../doc.pdf", lambda v: names.safe_path(F.lit("/base"), [F.lit("../unsafe")], v)) == "/base/unsafe/doc.pdf"


@pytest.mark.parametrize(("name", "expected"), [("Braine-l'Alleud", "Braine-lAlleud"), ("Écaussinnes", "caussinnes"), ("Brussel -Bruxelles", "Brussel_-Bruxelles"), ("", "gemeente")])
def test_slug(spark, name, expected):
    assert one(spark, name, names.slug) == expected


@pytest.mark.parametrize(("url", "ok"), [("https://example.com/doc.pdf", True), ("http://example.com", True), (" https://x.be ", True), ("ftp://example.com/file", False), ("/relative/path", False), ("", False), (None, False)])
def test_urls(spark, url, ok):
    assert one(spark, url, urls.is_valid) is ok


def test_host_modes(spark):
    assert one(spark, "www.waterloo.be", urls.bare_host) == "waterloo.be"
    assert one(spark, "www.waterloo.be", lambda v: urls.bare_host(v, faithful=True)) == "aterloo.be"


def test_view_suffix(spark):
    assert one(spark, "/a/x.PDF/view", urls.without_view) == "/a/x.PDF"


@pytest.mark.parametrize(
    ("url", "kind"),
    [(" ", "leeg"), (None, "leeg"), ("https://www.conseilcommunal.be/commune/13", "idelibe"), ("https://www.conseilcommunal.be/commune/5", "deliberations"), ("https://www.burdinne.be/x", "imio"), ("https://www.waterloo.be/x", "wordpress"), ("https://lblod.aalst.be", "lblod"), ("https://xlblod.be", "overig"), ("https://publi.irisnet.be/molenbeek.irisnet.be", "irisnet"), ("https://x.be/SITES/a/files/y", "drupal")],
)
def test_cascade(spark, url, kind):
    assert one(spark, url, catalogue.classify) == kind


def test_read_catalogue(spark, tmp_path):
    path = tmp_path / "catalogue.csv"
    path.write_text("﻿Gemeente;Bron\nA;https://www.thuin.be/x\nB;\n;https://x.be\nC;ftp://x\nD;https://lblod.d.be;extra\n", encoding="utf-8")
    rows = {r["entity"]: (r["type"], r["base_url"], r["problem"]) for r in catalogue.read_catalogue(spark, str(path)).collect()}
    assert rows == {"A": ("imio", "https://www.thuin.be", None), "B": ("leeg", "", None), "": ("overig", "https://x.be", "no name"), "C": ("overig", "", "invalid URL"), "D": ("lblod", "https://lblod.d.be", None)}
    assert [r["line_no"] for r in catalogue.numbered(spark, str(path)).orderBy("line_no").collect()] == [1, 2, 3, 4, 5, 6]


def test_organ_empty_name_matches_two_way(spark):
    assert one(spark, "", lambda v: filters.organ_two_way(v, F.lit("raad"))) is True


def test_first_occurrence_keeps_least_position(spark):
    rows = spark.createDataFrame([(1, "a", 3), (1, "a", 1), (1, "b", 2), (2, "a", 9)], "s int, k string, pos int")
    out = ordered.first_occurrence(rows, ["k"], ["pos"], ["s"])
    assert sorted((r["s"], r["k"], r["pos"]) for r in out.collect()) == [(1, "a", 1), (1, "b", 2), (2, "a", 9)]


def test_stop_is_within_filter(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 1), (4, 7)], "pos int, age int").withColumn("s", F.lit(0))
    stopped = ordered.until_first_old(rows, F.col("age") < 3, ["s"], ["pos"])
    assert sorted(r["pos"] for r in stopped.collect()) == [1, 2]


def test_ancestor_default(spark):
    parents = spark.createDataFrame([("a", "r", "A"), ("r", None, "R")], "id string, parent string, name string")
    rows = spark.createDataFrame([("a",), ("x",)], "id string")
    assert {r["id"]: r["ancestor"] for r in lookups.nearest_ancestor(rows, parents, 1, F.lit("d")).collect()} == {"a": "R", "x": "d"}
