"""Secrets that the models find in parts of tokens, against ordinary long words."""

import random
import string

import pytest

from gavel.llm import secrets

WORDS = "municipal archive signature budget harbour fountain bicycle veterinary orchestra quarantine dictionary wavelength".split()


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return secrets.train(secrets.samples(spark, docs))


def marked(spark, table, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[t[s["start"] : s["end"]] for s in r["secrets"] if s["kind"] == "markov"] for t, r in zip(texts, secrets.scan(docs, table).orderBy("doc_id").collect(), strict=True)]


def test_letters_only(spark, table):
    draw = random.Random(21)
    keys = ["".join(draw.choice(string.ascii_letters) for _ in range(32)) for _ in range(200)]
    found = marked(spark, table, [f"the key {k} is here" for k in keys])
    assert sum(f == [k] for f, k in zip(found, keys, strict=True)) >= 190


def test_long_words_are_left_alone(spark, table):
    draw = random.Random(22)
    pick = lambda: draw.sample(WORDS, 3)
    plain = [["".join(w.capitalize() for w in pick()), "".join(pick()), "_".join(pick()).upper(), "/".join(pick()), "-".join(pick())][i % 5] for i in range(300)]
    assert sum(map(bool, marked(spark, table, plain))) <= 3


def test_end_of_a_path(spark, table):
    key = "q7Zt0XvK4mWb9LsR2dHy"
    path = "archive/municipal/harbour/dictionary/orchestra/quarantine/veterinary/budget/wavelength/fountain/bicycle/signature"
    (found,) = marked(spark, table, [f"see {path}/{key} there"])
    assert found in ([key], [f"{path}/{key}"])
    assert marked(spark, table, ["", key])[1] == [key]
