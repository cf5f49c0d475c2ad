"""Settings of source types as one plan, adapters, and the gates of a harvest."""

import pytest
from pyspark.sql import functions as F

from gavel.operators import catalogue, sinks
from gavel.sources import adapters
from gavel.sources.adapters import Gate, Source

AS_OF = "2024-12-31"


def links(spark, *rows):
    return spark.createDataFrame(list(rows), "type string, entity string, page_id long, pos long, link string, label string")


def chosen(found, terms=None, **options):
    return sorted((r["link"], str(r["day"])) for r in adapters.select_documents(found, F.lit(AS_OF).cast("date"), terms, **options).collect())


def test_each_type_has_its_own_way(spark):
    found = links(
        spark,
        ("irisnet", "a", 1, 0, "/undated", "x"), ("irisnet", "a", 1, 1, "/old", "2023-12-01"), ("irisnet", "a", 1, 2, "/new", "2024-12-01"),  # undated ones go
        ("docodis", "a", 1, 0, "/undated", "x"), ("docodis", "a", 1, 1, "/new", "2024-12-01"), ("docodis", "a", 1, 2, "/new", "2024-12-02"), ("docodis", "a", 2, 0, "/new", "2024-12-03"),  # once a page
        ("pubcon", "a", 1, 0, "/p", "01/12/2024"), ("pubcon", "a", 2, 0, "/p", "02/12/2024"), ("pubcon", "b", 3, 0, "/p", "03/12/2024"),  # once an entity
        ("lblod", "a", 1, 0, "/l", "1 december 2024"), ("lblod", "a", 1, 1, "/l", "2 december 2024"),  # as often as it comes
        ("meetingburger", "a", 1, 0, "/m1", "1 december 2024"), ("meetingburger", "a", 1, 1, "/m2", "1 december 2022"), ("meetingburger", "a", 1, 2, "/m3", "2 december 2024"),  # up to the first old one
        ("unheard", "a", 1, 0, "/doc-20241201.pdf", "x"), (None, "a", 1, 0, "/doc-20241202.pdf", "x"),  # the usual settings
    )
    assert chosen(found) == sorted([("/new", "2024-12-01"), ("/new", "2024-12-01"), ("/new", "2024-12-03"), ("/undated", "None"), ("/p", "2024-12-01"), ("/p", "2024-12-03"), ("/l", "2024-12-01"), ("/l", "2024-12-02"), ("/m1", "2024-12-01"), ("/doc-20241201.pdf", "2024-12-01"), ("/doc-20241202.pdf", "2024-12-02")])


def test_filters_look_where_the_type_looks(spark):
    found = links(spark, ("icordis", "a", 1, 0, "/notulen", "x"), ("icordis", "a", 1, 1, "/y", "notulen"), ("docodis", "a", 1, 0, "/notulen", "x"), ("docodis", "a", 1, 1, "/y", "Notulen"), ("ixelles", "a", 1, 0, "/notulen", "x"), ("ixelles", "a", 1, 1, "/y", "notulen"))
    assert [x for x, _ in chosen(found, ["notulen"])] == ["/notulen", "/notulen", "/y", "/y"]
    assert len(chosen(found, [" "])) == 6


def test_one_plan_equals_type_after_type(spark):
    kinds = sorted([*adapters.SOURCES, "forest"])
    rows = [(kinds[i % 21], f"e{i % 4}", i % 17, i, f"/p{i % 29}/2024{i % 12 + 1:02d}{i % 28 + 1:02d}.pdf", f"{i % 28 + 1}/{i % 12 + 1:02d}/2024 séance du {i % 28 + 1}/{i % 12 + 1:02d}/2024") for i in range(600)]
    found = links(spark, *rows).cache()
    one = adapters.select_documents(found, F.lit(AS_OF).cast("date")).select("type", "link", "day").collect()
    for k in ("meetingburger", "ixelles", "forest"):
        own = adapters.adapter(k).extract(found, F.lit(AS_OF).cast("date")).select("type", "link", "day").collect()
        assert sorted(r for r in one if r["type"] == k) == sorted(own) and own, k


def test_a_case_has_one_branch_for_a_value(spark):
    text = str(adapters.by_type(F.col("type"), lambda s: s.cutoff))
    assert text.count("WHEN") == 1 + len({s.cutoff for s in adapters.SOURCES.values()} - {Source().cutoff})


def test_policies_differ_within_one_table(spark):
    schema = "type string, url string, hint string, disposition string, content_type string, status int, body string"
    docs = spark.createDataFrame([(k, "https://a.be/x", f"{k}{i}", None, "application/pdf", 200, body) for k in ("lblod", "idelibe", "imio", "forest") for i, body in enumerate(["<html>", "%PDF-1.4", "x" * 200])], schema)
    out = {r["file"]: r["success"] for r in sinks.stored(docs, spark.createDataFrame([], "file string"), adapters.policies(F.col("type"))).collect()}
    assert {k for k, good in out.items() if good} == {"lblod2.pdf", "idelibe0.pdf", "idelibe1.pdf", "idelibe2.pdf", "imio1.pdf", "forest1.pdf"}


def test_organs(spark):
    pages = spark.createDataFrame([("docodis", "e", 1, "https://e", "<select name=organ><option value=1>Raad</option><option value=2>College</option></select>"), ("imio", "f", 2, "https://f", "<select name=organ><option value=1>x</option></select>")], "type string, entity string, page_id long, url string, html string")
    assert sorted(r["organ"] for r in adapters.adapter("docodis").organs(pages).collect()) == ["College", "Raad"]
    assert adapters.adapter("imio").organs(pages).count() == 0


@pytest.fixture(scope="module")
def entities(spark):
    types = {t: flags for t, *flags in catalogue.TYPES}
    rows = [(f"Town {k}", k, types[k][0], types[k][3]) for k in ("imio", "ibabs", "docodis", "overig")]
    return spark.createDataFrame(rows, "name string, type string, has_handler boolean, has_organs boolean")


def test_gates(spark, entities):
    for wrong, said in (({}, "name an entity"), ({"kind": "docodis"}, "name an organ"), ({"name": "town d"}, "name an organ"), ({"kind": "none", "everything": True}, "nothing fits"), ({"organ": "Raad", "everything": True}, "not both")):
        with pytest.raises(Gate, match=said):
            adapters.selected(entities, **wrong)
    assert [(r["type"], r["organ"]) for r in adapters.selected(entities, kind="imio").collect()] == [("imio", None)]
    assert sorted((r["type"], r["organ"]) for r in adapters.selected(entities, organ="Raad").collect()) == [("docodis", "Raad"), ("ibabs", "Raad"), ("imio", None)]
    assert [r["type"] for r in adapters.selected(entities, name="TOWN OV", everything=True).collect()] == ["overig"]
    assert adapters.selected(entities, everything=True).count() == 3
