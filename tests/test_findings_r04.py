"""What the fourth round's findings named, on small tables that show it."""

from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F
from test_findings_r03 import differs

from gavel.operators import sinks
from gavel.sources import files


def test_listing_is_not_the_drivers(spark, tmp_path):
    """Tasks do not grow with the files, and Spark takes the listing for large until it has been counted."""
    for k in range(600):
        folder = tmp_path / f"s{k % 3}" / ("deep" if k % 2 else "")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{k}.txt").write_text("x" * (k % 5))
    found = sinks.files_below(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert "Scan" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 10**12
    for uri in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        assert {(r["file"], r["bytes"]) for r in sinks.files_below(spark, uri).collect()} == {(str(p.relative_to(tmp_path)), p.stat().st_size) for p in tmp_path.rglob("*.txt") if p.stat().st_size}


def test_hidden_folders_are_listed(spark, tmp_path):
    rows = [(5 * i + i % 3, "x" * 120, source, "nl", 120) for i, source in enumerate(["_web", ".web", "w=1", "a b%20", "é/_x"] * 3)]
    assert differs(spark, tmp_path, "files_written", documents=(rows, "doc_id long, text string, source string, lang string, n_chars long")) == ""


def test_a_commit_lists_a_part_at_a_time(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART", 10)
    monkeypatch.setattr(files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(taskAttemptId=lambda: 7)))
    writer = files.FileWriter({"path": str(tmp_path / "x")})
    told = writer.write(iter([{"file": f"s{k % 3}/{k}.txt", "body": str(k)} for k in range(25)] + [{"file": "30.txt", "body": None}]))
    staged = Path(tmp_path, "x", told.folder)
    assert [sum(p.is_file() for p in part.rglob("*")) for part in sorted(staged.iterdir())] == [10, 10, 6]
    none = files.FileWriter({"path": str(tmp_path / "x")}).write(iter([]))
    assert (none.parts, none.files) == (0, 0)
    writer.commit([told, None])
    assert {str(p.relative_to(tmp_path / "x")): p.read_text() for p in Path(tmp_path, "x").rglob("*.txt")} == {f"s{k % 3}/{k}.txt": str(k) for k in range(25)} | {"30.txt": ""}


def test_names_of_a_large_listing_are_not_broadcast(spark, tmp_path):
    """A listing over the broadcast limit meets documents by a shuffle."""
    for k in range(300):
        (tmp_path / f"{k}.pdf").write_text("x")
    docs = spark.range(400).select(F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("hint"), F.lit("https://x.be/d").alias("url"), F.lit(None).cast("string").alias("disposition"), F.lit("application/pdf").alias("content_type"), F.lit(200).alias("status"), F.lit("%PDF-1").alias("body"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        judged = sinks.stored(docs, sinks.files_below(spark, str(tmp_path)))
        assert judged.filter("skipped").count() == 300
        judged.collect()
        assert "Broadcast" not in judged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
