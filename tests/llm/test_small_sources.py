"""Sources of the mix that are smaller than a block."""

from gavel.llm import mixing


def test_small_sources_reach_their_targets(spark):
    large = [(i, f"large{i % 4}", "word " * 2500) for i in range(32)]
    small = [(100 + i, f"small{i // 2:02}", f"small{i} " * (5 + i % 2 * 10)) for i in range(80)]
    docs = spark.createDataFrame([*large, *small, (999, "no words", " ")], "doc_id long, source string, text string")
    by = {}
    for r in mixing.mix(docs, slots=1024).collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert len(by) == 45
    for source, (taken, target) in by.items():
        assert abs(taken - target) <= (0.01 * target if source.startswith("large") else 0.5), source
    kept = mixing.mixed_documents(docs, slots=1024).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in kept if r["doc_id"] >= 100} == {i: 2 for i in range(100, 180)}


def test_small_sources_below_their_size(spark):
    docs = spark.createDataFrame([(i, f"s{i // 10:03}", "word " * 40) for i in range(2000)], "doc_id long, source string, text string")
    by = {}
    for r in mixing.mix(docs, slots=256).collect():
        by.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert min(t for _, t in by.values()) < 400  # some targets lie below the source's own words
    assert all(abs(taken - target) <= 0.5 for taken, target in by.values())
