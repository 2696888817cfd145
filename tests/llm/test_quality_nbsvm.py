"""The quality classifier on rows that it never saw."""

import zlib

import duckdb
import numpy as np

from funnelloom.llm import quality_nbsvm as Q
from funnelloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_accuracy(spark):
    labels = dict(duckdb.sql(f"select doc_id, quality from '{FOLDER}/labels.parquet'").fetchall())
    found = QUERIES["op8_quality"](spark, FOLDER).collect()
    assert len(found) == 1000
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    tested = [(r.score, r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    scores, predicted, truth = map(np.array, zip(*tested))
    assert auc(scores, truth) > 0.97
    assert (predicted == truth).mean() > 0.95


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", Q.F.when(Q.held_out(), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = Q.fit(docs, labels, 300), Q.fit(docs, turned, 300)
    assert a.slope == b.slope and (a.weights == b.weights).all()


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows = [(np.array([0, 1]), v / np.linalg.norm(v)) for v in rng.normal(size=(60, 2))]
    signs = np.array([1.0 if v[0] + 0.3 * v[1] > 0 else -1.0 for _, v in rows])
    weights, bias = Q.dual_coordinate_descent(rows, signs, np.ones(60))

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + sum(max(0, 1 - s * (w @ v + b)) for (_, v), s in zip(rows, signs))

    best = loss(weights[:2], bias)
    for _ in range(300):
        assert best <= loss(weights[:2] + rng.normal(size=2) * 0.3, bias + rng.normal() * 0.3) * 1.02


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a " * 30000), (3, "x"), (None, "Some words here.")]
    docs = spark.createDataFrame([(d, t, "c", 2.0) for d, t in rows], "doc_id long, text string, quality string, score double")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, 1), (1, None), (None, 0)], "doc_id long, quality int")
    for labels, want in ((empty, 0.5), (one, None)):
        found = Q.score(docs, Q.fit(docs, labels)).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert want is None or all(r.score == want for r in found)
    assert Q.score(docs.limit(0), Q.constant(0.5)).count() == 0


def test_scores_do_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    a = Q.fit(docs, labels, 300)
    b = Q.fit(docs.repartition(7, "doc_id"), labels.repartition(3), 300)
    assert a.slope == b.slope and a.offset == b.offset and (a.weights == b.weights).all()


def test_repeated_ids_add_no_rows_to_the_fit(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    a, b = Q.fit(docs, labels, 300), Q.fit(docs.unionByName(docs).unionByName(docs), labels, 300)
    assert a.slope == b.slope and (a.weights == b.weights).all()
