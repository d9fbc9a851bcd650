import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.llm import language

DATA = "/root/testdata/sf0.01/documents.parquet"


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the synthetic tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    out = language.predict(docs, language.train(docs, per_class=150)).withColumn("held", language.held_out(F.col("doc_id")))
    held = out.where("held and lang is not null and lang_pred <> 'und'")
    n, right = held.count(), held.where("lang = lang_pred").count()
    assert n > 100 and right / n > 0.97


def test_cases(spark, docs, empty):
    out = language.predict(docs, language.train(docs))
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    by_id = {r.doc_id: r for r in out.collect()}
    for i in (3, 4, 5):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[1].lang_pred in ("en", "de") and 0 <= by_id[1].score <= 1
    none = language.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}
    one = language.train(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in language.predict(docs.where("doc_id = 6"), one).collect()} == {"en"}
    assert language.predict(empty, one).count() == 0 and language.keep_known(docs).columns == docs.columns


def test_letters_decide_und():
    assert language.features("12 34 !?") is None and language.features("") is None
    assert language.features("7 é") is not None and language.features("日本") is not None


def test_clashing_columns_and_ties(spark):
    names = ["judged", "judged_", "level", "a", "id", "label", "SCORE"]
    rows = [(i, t, lang, *[f"{c}{i}" for c in names]) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("same words", "en"), ("same words", "de")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in names))
    model = language.train(df)
    out = language.predict(df, model)
    assert out.columns == [*df.columns[:-1], "lang_pred", "score"]
    assert sorted(tuple(r)[:9] for r in out.collect()) == [r[:9] for r in rows]
    assert out.orderBy("doc_id").collect() == language.predict(df, language.train(df.repartition(3))).orderBy("doc_id").collect()


def test_too_many_labels(spark):
    df = spark.range(2 * language.MOST_LANGUAGES).selectExpr("id AS doc_id", "'some text' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError):
        language.train(df)


def test_machine_separates():
    draw = np.random.default_rng(1)
    at = [np.sort(draw.choice(50, 9, replace=False)) + (0 if i % 2 else 30) for i in range(80)]
    value = [np.full(9, 1 / 3) for _ in at]
    y = np.array([1 if i % 2 else -1 for i in range(80)])
    w, bias = language.train_machine(at, value, y)
    assert np.mean([np.sign(w[a] @ v + bias) == s for a, v, s in zip(at, value, y, strict=True)]) > 0.9
