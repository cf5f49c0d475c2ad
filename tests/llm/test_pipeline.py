"""The pipeline on the smallest tables: what each stage keeps, and the whole against plain Python."""

import corpus_pipeline
from pyspark.sql import functions as F


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert after.columns == columns
        counts.append(after.count())
        docs = after
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == counts[-1]
    assert counts[0] >= counts[1] >= counts[2] > 0
    assert out.groupBy("shard").agg((F.max("slot") + 1 - F.count("*")).alias("d")).filter("d <> 0").count() == 0
    assert out.groupBy("doc_id").count().filter("count > 2").count() == 0


def test_what_stages_write_is_removed(spark, sf_dir):
    from pathlib import Path

    from gavel.llm import storage

    folder = Path(storage.shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = corpus_pipeline.run(spark, sf_dir)
    left = [p.name for p in set(folder.iterdir()) - before if p.name.startswith(("pipeline-", "near-", "links-", "bench-", "mix-"))]
    assert len(left) == 1 and left[0].startswith("pipeline-mixing") and out.count() > 0


def awkward(spark):
    """Documents with columns of names that stages use themselves, null and very long texts, ties and repeated rows."""
    words = " ".join(f"word{i % 991} of{i % 13}" for i in range(60_000))
    texts = [None, "", "123 !", "one two three", "one two three", words, words + " end", "été à Paris", " \n ", "same words in all of these rows", "same words in all of these rows"]
    rows = [(i if i % 4 else None, t, "en", "s" if i % 2 else None) for i, t in enumerate(texts)] + [(7, "été à Paris", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ["score", "lang_pred", "a.b", "Weird `name", "__key", "__row", "row", "extra", "key", "copies", "n_words", "item_ids", "__id", "size", "taken", "__source", "__bucket", "Shard", "slot", "Shard_before", "doc_id_2"]
    return docs.withColumns({n: F.concat_ws("|", F.lit(n), F.coalesce("doc_id", F.lit(-1)), F.length("text")) for n in names})


def test_no_stage_changes_a_column(spark, sf_dir):
    docs = corpus_pipeline.materialise(awkward(spark), "test-awkward")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {tuple(r) for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        last = name == "sharding"
        assert docs.columns == first if not last else len(docs.columns) == len(first) + 2
        assert docs.count() > 0 and {tuple(r)[: len(first)] for r in docs.collect()} <= before, name
        if last:
            assert {"Shard_before_before", "Shard_before", "slot_before", "shard", "slot"} <= set(docs.columns)


def test_empty_documents(spark, sf_dir):
    docs = corpus_pipeline.materialise(awkward(spark).limit(0), "test-empty")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.count() == 0
