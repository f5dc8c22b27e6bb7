import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import quality_knn, queries
from tests.llm import helpers


def text(rng, good):
    words = [f"w{chr(97 + rng.randrange(26))}{rng.choice(['er', 'tion', 'ing'])}" for _ in range(rng.randint(60, 150))]
    if good:
        return " ".join(words).capitalize() + "."
    return " ".join(w.upper() + "!!" for w in words) if rng.random() < 0.5 else " | ".join(words)


def made(spark, size=160):
    rng = random.Random(4)
    quality = [int(rng.random() < 0.7) for _ in range(size)]
    return [text(rng, q) for q in quality], quality


def labels(spark, quality):
    rows = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, 0) for i, q in enumerate(quality)]
    return spark.createDataFrame(rows, "doc_id bigint, quality bigint, toxic bigint")


def test_held_out_accuracy(spark, tmp_path):
    own, quality = made(spark)
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, own), labels=labels(spark, quality))
    rows = {r.doc_id: r for r in queries.op9_quality_knn(spark, sf).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [i for i in rows if rows[i].held_out]  # their labels are wrong and must not be learned
    assert len(held) > 20 and all(rows[i].predicted == quality[i] for i in held)


def test_votes_against_brute_force():
    rng = np.random.default_rng(2)
    counts = rng.random((60, quality_knn.TERMS)).astype(np.float32) * (rng.random((60, quality_knn.TERMS)) < 0.05)
    model = quality_knn.fit(counts, rng.integers(0, 2, 60).astype(np.float32))
    queries_ = counts[:20] + 0.1 * counts[20:40]
    found = quality_knn.vote(queries_, model)
    vectors = quality_knn.vectors_of(queries_, model.project)
    for i, v in enumerate(vectors):
        similar = model.vectors @ v
        near = np.argsort(-similar, kind="stable")[: quality_knn.NEIGHBOURS]
        weight = np.maximum(similar[near], 0) ** quality_knn.POWER
        assert abs(found[i] - (weight * model.labels[near]).sum() / weight.sum()) < 1e-5


def test_ties_go_by_the_samples_order():
    """Forty neighbours in four groups of equal vectors, so that the 25th place lies within a tie."""
    rng = np.random.default_rng(3)
    kinds = quality_knn.stepped(rng.random((4, quality_knn.TERMS)) * (rng.random((4, quality_knn.TERMS)) < 0.05), quality_knn.COUNT_STEP)
    for trial in range(20):
        group = rng.permutation(np.repeat(np.arange(4), 10))
        model = quality_knn.fit(kinds[group].astype(np.float32), rng.integers(0, 2, 40).astype(np.float32))
        for i, score in enumerate(quality_knn.vote(kinds, model)):
            own = quality_knn.vectors_of(kinds[i : i + 1], model.project)[0]
            similar = [sum(int(a * 2**15) * int(b * 2**15) for a, b in zip(v, own, strict=True)) for v in model.vectors]
            near = sorted(range(40), key=lambda j: (-similar[j], j))[: quality_knn.NEIGHBOURS]
            weight = [max(similar[j] / 2**30, 0) ** quality_knn.POWER + 1e-12 for j in near]
            wanted = sum(w * model.labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight)
            assert abs(score - wanted) < 1e-12, (trial, i)


def test_scores_do_not_depend_on_the_block():
    rng, table = random.Random(5), quality_knn._classes()
    texts = [text(rng, rng.random() < 0.5) for _ in range(300)]
    counts = quality_knn.term_counts(texts, table)
    model = quality_knn.fit(counts[:200], (np.arange(200) % 3 > 0).astype(np.float32))
    whole = quality_knn.vote(counts, model)
    alone = [quality_knn.vote(quality_knn.term_counts([t], table), model)[0] for t in texts]
    assert whole.tolist() == alone and quality_knn.vote(counts[::-1], model)[::-1].tolist() == alone


def test_an_id_with_many_rows_counts_once(spark, monkeypatch):
    """One labelled id on a third of all documents and on many label rows."""
    monkeypatch.setattr(quality_knn, "SAMPLE", 10)
    own, quality = made(spark)
    df = helpers.documents(spark, own).withColumn("doc_id", F.expr("if(doc_id % 3 = 0, 0, doc_id)"))
    known = [(0, 1)] * 50 + [(0, 0)] + [(i, q) for i, q in enumerate(quality)]
    model = quality_knn.learn(df, spark.createDataFrame(known, "doc_id bigint, quality int"))
    assert len(model.labels) <= 20
    again = quality_knn.learn(df.repartition(5), spark.createDataFrame(known[::-1], "doc_id bigint, quality int"))
    assert (model.labels == again.labels).all() and len(model.vectors) == len(again.vectors)


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality_knn, "SAMPLE", 10)
    own, quality = made(spark)
    df = helpers.documents(spark, own)
    model = quality_knn.learn(df, spark.createDataFrame([(i, q) for i, q in enumerate(quality)], "doc_id bigint, quality int"))
    again = quality_knn.learn(df.repartition(7), spark.createDataFrame([(i, q) for i, q in enumerate(quality)], "doc_id bigint, quality int"))
    assert len(model.labels) == 20 and model.labels.sum() == 10
    assert np.allclose(model.vectors @ model.vectors.T, again.vectors @ again.vectors.T, atol=1e-4)


def test_odd_tables(spark):
    own, quality = made(spark, 40)
    known = spark.createDataFrame([(i, q) for i, q in enumerate(quality)] + [(None, 1), (7, None), (999, 1)], "doc_id bigint, quality int")
    model = quality_knn.learn(helpers.documents(spark, own), known)
    found = quality_knn.classify(helpers.odd(spark), model)
    rows = {r.row.doc_id: r.result.score for r in found.collect()}
    assert found.columns == ["row", "result"] and rows[0] == rows[1] == model.prior
    nothing = quality_knn.learn(helpers.empty(spark), known.limit(0))
    assert {r.result.score for r in quality_knn.classify(helpers.odd(spark), nothing).collect()} == {0.5}
    assert quality_knn.classify(helpers.empty(spark), model).count() == 0
