"""The Merkle manifest against plain Python: hot keys, repeated rows, nulls, many groups, ranks of skewed keys."""

import hashlib
import zlib

from pyspark.sql import functions as F

from gavel.llm import manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def climb(digests):
    """Root, and for each leaf its (left, right) by level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, k in enumerate(at):
            lo = k // 8 * 8
            paths[i].append(("".join(level[lo:k]), "".join(level[k + 1 : lo + 8])))
        at, level = [k // 8 for k in at], [h("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    """Sorted (doc_id, lang, rank, leaf, subroot, root, path) of rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in order:
        own = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = (own, *climb([leaf(r) for r in own]))
    root, upper = climb([trees[g][1] for g in order]) if order else ("", [])
    for g, above in zip(order, upper, strict=True):
        own, subroot, paths = trees[g]
        out += [(r["doc_id"], g, i, leaf(r), subroot, root, [*p, *above]) for i, (r, p) in enumerate(zip(own, paths, strict=True))]
    return sorted(out, key=str)


def found(frame, **options):
    return sorted(((r["doc_id"], r["lang"], r["rank"], r["leaf"], r["subroot"], r["root"], [tuple(x) for x in r["path"]]) for r in manifest.manifest(frame, FIELDS, **options).collect()), key=str)


def rows_of(*tuples):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), t, strict=True)) for t in tuples]


def test_against_plain_python(spark):
    many = [(i * 37 - 4000, f"text {i}", ["en", "fr", None, "", "é", "enx"][i % 6] if i % 3 else "en", None if i % 5 == 0 else "s", i) for i in range(700)]
    hot = [(7, f"again {i}", "en", None, None) for i in range(300)] + [(8, "the same", "en", "s", 8)] * 200 + [(None, f"no id {i % 9}", "fr", "s", 1) for i in range(40)]
    edge = [(2**63 - 1, "", "de", "s", 0), (-(2**63), None, "de", None, None), (0, "A" * 200_000 + "é" * 1000, "alone", "s", 3)]
    rows = rows_of(*many, *hot, *edge)
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5)
    want = brute(rows)
    assert found(frame) == want
    assert found(frame, bucket=4) == want  # buckets are split down to the leaf and to equal rows
    clash = frame.withColumns({n: F.lit(n) for n in ("group", "rank", "digest", "key", "__key", "a.b", "path")})
    assert found(clash, bucket=64) == want


def test_small_and_empty_tables(spark):
    for rows in ([], rows_of((1, "x", None, None, None)), rows_of((1, "x", "a", "s", 1), (2, "y", "b", "s", 1)), rows_of(*((i, "t", f"lang{i}", "s", i) for i in range(70)))):
        assert found(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)) == brute(rows)


def test_ranks_of_skewed_keys(spark):
    keys = [f"{k:04x}" for k in range(0, 60_000, 97)] + ["8" * 60 + f"{k:03x}" for k in range(900)] + ["8", "88", "ffff0"]
    frame = spark.createDataFrame([("g" if i % 3 else "h", k) for i, k in enumerate(keys)], "group string, key string")
    out = manifest.ranked(frame.withColumn("own", F.col("key")), bucket=16).collect()
    for g in "gh":
        own = sorted(k for i, k in enumerate(keys) if (i % 3 == 0) == (g == "h"))
        assert sorted((r["rank"], r["own"], r["width"]) for r in out if r["group"] == g) == [(i, k, len(own)) for i, k in enumerate(own)]


def test_query_finds_what_was_tampered_with(spark, sf_dir):
    from gavel.llm import queries

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op11_manifest(spark, sf_dir).collect():
        text = docs[r["doc_id"]]["text"]
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None and any("A" <= c <= "Z" for c in text)
        assert r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == r["verified"]
