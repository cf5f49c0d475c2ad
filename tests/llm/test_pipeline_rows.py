"""run() of the pipeline against plain Python, row by row; of the first stage only the predictions are taken as given."""

import hashlib
import re

import corpus_pipeline
import numpy as np

from gavel.llm import language, mixing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = " ".join(f"item{i}" for i in range(20))
md5 = lambda t: hashlib.md5(t.encode()).hexdigest()


def fixture():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrst"), rng.integers(2, 8)))
    texts = [" ".join(word() for _ in range(rng.integers(1, 120))) for _ in range(150)]
    for i in range(100, 130):  # copies and near copies
        w = texts[i - 60].split()
        texts[i] = " ".join([*w[:-1], "other"] if i % 2 else w)
    for i in range(130, 140):  # a large and a small part of a benchmark passage
        texts[i] = f"{ITEM} {texts[i]}" if i % 2 else " ".join(f"{i}w{k}" for k in range(300)) + f" {ITEM[:100]}"
    texts[140:146] = [None, "", " \n", "123 456 !!", texts[3], texts[3].upper()]
    return [(i, t, ["en", "fr", None][i % 3], "tiny" if i in (5, 7) else [None, "a", "b", "c"][i % 4]) for i, t in enumerate(texts)]


def deduplicated(rows):
    sets = []
    for _, t, _ in rows:
        w = t.translate(LOWER).split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    return [r for k, r in enumerate(rows) if group.index(group[k]) == k]  # ids ascend


def decontaminated(rows):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    item = split(ITEM)
    windows = {tuple(item[k : k + 13]) for k in range(len(item) - 12)}
    out = []
    for r in rows:
        w = split(r[1])
        hit = {q for k in range(len(w) - 12) if tuple(w[k : k + 13]) in windows for q in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def mixed(rows):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    words = [sum(size(r) for r in rows if r[2] == s) for s in sources]
    weight, budget = [(3, 1, 2)[k % 3] for k in range(len(sources))], 1.5 * sum(words)
    low, high = 0.0, 2.0 * budget
    for _ in range(200):  # the level at which the capped targets spend the budget
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * n, level * w) for n, w in zip(words, weight)) < budget else (low, level)
    target = [min(2.0 * n, high * w) for n, w in zip(words, weight)]
    slots = 1 << (int(budget) - 1).bit_length()
    assert slots <= mixing.SLOTS
    edges, got = np.cumsum(target) / sum(target), [0] * len(sources)
    for i in range(slots):
        point = int(format(i, f"0{slots.bit_length() - 1}b")[::-1], 2) / slots
        got[min(int((edges <= point).sum()), len(sources) - 1)] += 1
    out = []
    for k, s in enumerate(sources):
        n, own = words[k], target[k] < 200 * budget / slots
        blocks, takes = (n, round(target[k])) if own else (max(1, round(n / (budget / slots))), got[k])
        times = np.zeros(n, dtype=int)
        for b in range(blocks):
            times[b * n // blocks : (b + 1) * n // blocks] = min(2, takes // blocks + (b < takes % blocks))
        at = 0
        for r in sorted((r for r in rows if r[2] == s), key=lambda r: md5(f"mix:{r[0]}:{md5(r[1])}")):
            out += [r] * int(times[at : at + size(r)].sum() / size(r) + 0.5)
            at += size(r)
    return sorted(out, key=lambda r: r[0])


def sharded(rows):
    sizes, before, out = [len(r[1].encode()) + 8 for r in rows], 0, []
    for r, n in zip(rows, sizes, strict=True):
        shard = min(23, (2 * before + n) * 24 // (2 * sum(sizes)))
        out.append((*r, shard, sum(x[3] == shard for x in out)))
        before += n
    return out


def test_run_equals_plain_python(spark, tmp_path):
    rows = fixture()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"] for r in language.predict(docs, language.train(docs)).filter("lang_pred <> 'und'").collect()}
    assert found == {d for d, t, *_ in rows if t and re.search("[a-zA-Z]", t)}
    stages = [[(d, t, s) for d, t, _, s in rows if d in found]]
    for stage in (deduplicated, decontaminated, mixed, sharded):
        stages.append(stage(stages[-1]))
    counts = [len(x) for x in stages]
    assert counts[0] > counts[1] > counts[2] and any(x[0] == y[0] for x, y in zip(stages[3], stages[3][1:], strict=False))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "text", "source", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[3], r[4])) == sorted(stages[4], key=lambda r: (r[0], r[3], r[4]))
