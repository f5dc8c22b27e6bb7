import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, sliced_search
from corpusmill import staging
from tests import compare
from tests.llm import helpers

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(documents, items):
    """The definition: every document scored for every item."""
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in documents]
    held = [c for c in counts if c[2]]
    n, total = len(held), sum(c[2] for c in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for name, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 75 + 75 * size * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(name, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out)


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "日本", "ß9", "Mixed", "UPPER"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 30, 30, 80, 300]))) for _ in range(n)]
    return rng, words, texts + texts[:15]


def searched(spark, documents, items):
    df = staging.stage(documents, "test-documents")
    index = staging.stage(sliced_search.build_index(df), "test-index")
    return sorted((r.item, r["rank"], r.id, r.score) for r in sliced_search.search(df, index, items).collect())


@pytest.mark.parametrize(("seed", "item_bytes", "block", "close"), [(1, 1 << 17, 1 << 17, 10**6), (2, 400, 64, 0), (3, 1500, 512, 10**6)])
def test_search_against_brute_force(spark, monkeypatch, seed, item_bytes, block, close):
    """With items in one block and in many, with large and small blocks, with both joins."""
    monkeypatch.setattr(sliced_search, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(sliced_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(sliced_search, "CLOSE", close)
    monkeypatch.setattr(sliced_search, "TERMS", 50)
    rng, words, texts = made(seed, 250)
    items = [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(12)] + [None, "", "!!", "nowhere", "w0 w0 W0", texts[7]]
    rows = list(enumerate(items)) + [(3, items[3]), (None, "w1 w2")]
    found = searched(spark, helpers.documents(spark, texts), spark.createDataFrame(rows, "item_id bigint, text string").fillna(-1, ["item_id"]))
    assert found == plain_search(list(enumerate(texts)), [(-1 if i is None else i, t) for i, t in rows])
    assert len(found) > 100


def test_bounds_are_never_below_scores_and_exclude_most():
    rng, words, texts = made(4, 400)
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in enumerate(texts) if terms(t)]
    items = [" ".join(rng.choices(words, k=8)) for _ in range(30)]
    counts = [Counter(x.encode() for x in terms(t)) for t in items]
    names = sorted(set().union(*counts))
    flat = [(i, names.index(t), n) for i, c in enumerate(counts) for t, n in c.items()]
    item, term, times = (np.array(x) for x in zip(*flat, strict=True))
    df = Counter(t.encode() for _, c, _ in held for t in c)
    weights = np.array([math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) for t in names])
    own = sliced_search.Items(names, weights, item, term, times, len(items), len(held), sum(h[2] for h in held))
    signed = []
    for i, c, n in held:
        whole = np.concatenate([sliced_search.entries([t.encode() for t, k in c.items() if k >= least], lv) for lv, least in enumerate(sliced_search.LEVELS)])
        signed.append(sliced_search.Signed(i, n, max(c.values()), np.unique(sliced_search.places(whole, 2048))))
    row = {k: v[0] for k, v in sliced_search.sliced(2048, signed).items()}
    bound = sliced_search.Bounds(own).of(2048, np.array(row["lengths"]), np.array(row["most"]), row["slices"])
    m = sliced_search.damping(np.array(row["lengths"]), own)
    exact = np.zeros(bound.shape)
    for i, t, n in flat:
        tf = np.array([c.get(names[t].decode(), 0) for _, c, _ in held])
        exact[i] += n * weights[t] * sliced_search.part(tf, m)
    assert (bound >= exact).all()
    best = np.sort(exact, axis=1)[:, -10]
    assert (bound >= best[:, None]).mean() < 0.1


def test_repeated_and_missing_ids(spark):
    rows = [(1, "alpha beta"), (1, "alpha"), (1, "alpha beta"), (None, "alpha beta gamma"), (2, "beta")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([("x", "alpha beta")], "item_id string, text string")
    assert searched(spark, df, items) == plain_search(rows, [("x", "alpha beta")])


def test_odd_tables(spark):
    items = spark.createDataFrame([(1, "word same 日本語")], "item_id bigint, text string").withColumn("item", F.lit("own"))
    found = searched(spark, helpers.odd(spark), items)
    assert {r[2] for r in found} == {2, 3, 5} and len(found) == 4
    assert searched(spark, helpers.empty(spark), items) == []
    assert searched(spark, helpers.odd(spark), items.limit(0)) == []


def test_query_equals_its_sql(spark, tmp_path):
    rng, words, texts = made(5, 200)
    items = spark.createDataFrame([(i, " ".join(rng.choices(words, k=6))) for i in range(9)], "item_id bigint, text string")
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, texts), benchmark=items)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet/*.parquet'")
    result = db.execute(queries.ORACLE["op11_sliced_search"])
    names = [d[0] for d in result.description]
    df = queries.op11_sliced_search(spark, sf)
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(names, result.fetchall())
