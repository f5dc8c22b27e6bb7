import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import components, queries, simhash
from tests.llm import helpers


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def roots(prints, near):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if near(prints[i], prints[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def plain_fingerprint(text, size):
    """The definition, word for word."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


LOWER = {c: c + 32 for c in range(65, 91)}


def test_fingerprints_by_definition():
    for text in ["", " \n", "one", "One TWO", "a b c", "a b c d a b c d", "É é \x1c x\x0by Z"]:
        hashes = simhash.shingle_hashes(simhash.words_of(text), 3)
        assert simhash.fingerprint(hashes) == signed(plain_fingerprint(text, 3)), text


@pytest.mark.parametrize(("distance", "pairwise", "lookup"), [(2, 1500, 2), (4, 2, 2), (1, 2, 0), (2, 2, 0)])
def test_components_against_brute_force(spark, distance, pairwise, lookup, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    monkeypatch.setattr(simhash, "LOOKUP", lookup)
    rng = random.Random(distance)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        x = rng.choice(prints[-100:])
        for _ in range(rng.randint(0, distance + 2)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    hot = rng.getrandbits(64)
    prints += [hot ^ (rng.getrandbits(12) << 50) for _ in range(150)]
    wanted = roots(prints, lambda a, b: (a ^ b).bit_count() <= distance)
    df = spark.createDataFrame([(i, signed(p), []) for i, p in enumerate(prints)], "id bigint, fingerprint bigint, proofs array<bigint>")
    found = simhash.group_prints(df.repartition(4), distance).collect()
    assert {r.id: r.component for r in found} == dict(enumerate(wanted))


def test_every_allowed_difference_has_a_chain():
    import numpy as np

    rng = random.Random(2)
    for distance in (1, 2, 3, 4, 7):
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, distance)))
            ring = range(distance + 1)
            assert any(simhash.chained(np.array([diff], np.uint64), np.array([i]), distance)[0] for i in ring)


def test_connected(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, x) for x in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (300, 300), (7, 3), (3, 7)], "a bigint, b bigint")
    found = {r.node: r.root for r in components.connected(edges).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 160)}
    assert components.connected(edges.limit(0)).count() == 0


def varied(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [None, "", " ", "One two", "one  TWO", "b"]
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(30, 400))]
        texts += [" ".join(words), varied(words, 1, rng), varied(words, 2, rng), "\n".join(words).upper()]
    prints = [plain_fingerprint(t, 3) for t in texts]
    wanted = roots(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, texts))
    rows = queries.op8_simhash(spark, sf).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in enumerate(prints)}
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(wanted))


def jaccard(a, b, size=5):
    sets = []
    for text in (a, b):
        words = text.lower().split()
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_one_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(4)
    texts, owner = [], []
    for group in range(40):
        words = [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"w{rng.randrange(3000)}" for _ in range(300)]
        texts.append(" ".join(words))
        owner.append(group)
        for changes in (0, 1, 3, 5):
            copy = varied(words, changes, rng)
            if jaccard(texts[-1 if changes == 0 else owner.index(group)], copy) >= 0.85:
                texts.append(copy)
                owner.append(group)
    kept = simhash.drop_near_duplicates(helpers.documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == [owner.index(g) for g in range(40)]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_odd_tables(spark):
    df = helpers.odd(spark, ["Same words here as there, again and again."])
    found = {(r.id, r.component) for r in simhash.near_duplicates(df).collect()}
    assert (10, 3) in found and (0, 0) in found and (1, 0) in found and (4, 0) in found and (None, None) in found
    assert simhash.near_duplicates(df).count() == 9
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 0), (False, 2), (False, 3), (False, 5), (True, None)]
    assert simhash.near_duplicates(helpers.empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(helpers.empty(spark)).count() == 0


def test_hot_group_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRWISE", 5)
    monkeypatch.setattr(simhash, "LOOKUP", 0)
    df = spark.range(400).select(
        F.col("id").alias("node"), (F.col("id") * 2**40).alias("fingerprint"), F.array().cast("array<bigint>").alias("proofs")
    )
    edges = simhash.near_links(df)
    assert edges.count() > 0
    found = {r.node: r.root for r in components.connected(edges).collect()}
    wanted = roots([i << 40 for i in range(400)], lambda a, b: (a ^ b).bit_count() <= 2)
    assert [found.get(i, i) for i in range(400)] == wanted
