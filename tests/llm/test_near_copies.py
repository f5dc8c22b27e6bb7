import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import near_copies, simhash
from tests.llm import helpers


def shingles(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def close_pairs(low, high, sizes, each, rng):
    """Texts and copies with words replaced until their similarity is between ``low`` and ``high``."""
    out = []
    for size in sizes:
        made = 0
        while made < each:
            words = [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"w{rng.randrange(5000)}" for _ in range(size)]
            copy = list(words)
            while jaccard(shingles(" ".join(words)), shingles(" ".join(copy))) > high:
                copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
            if jaccard(shingles(" ".join(words)), shingles(" ".join(copy))) >= low:
                out.append((" ".join(words), " ".join(copy)))
                made += 1
    return out


def test_copies_just_above_the_limit_are_joined(spark):
    pairs = close_pairs(0.80, 0.85, (50, 75, 100, 150, 200, 300, 400, 500), 25, random.Random(11))
    texts = [t for pair in pairs for t in pair]
    kept = {r.doc_id for r in simhash.drop_near_duplicates(helpers.documents(spark, texts)).collect()}
    assert kept == set(range(0, len(texts), 2))


def test_texts_just_below_the_limit_stay(spark):
    pairs = close_pairs(0.70, 0.799, (50, 200, 500), 20, random.Random(12))
    texts = [t for pair in pairs for t in pair]
    assert simhash.drop_near_duplicates(helpers.documents(spark, texts)).count() == len(texts)


@pytest.mark.parametrize("hot", [1, 1000])
def test_components_by_brute_force(spark, monkeypatch, hot):
    """Chains and members that the smallest of a band does not reach, with few and with all keys hot."""
    monkeypatch.setattr(near_copies.skew, "HOT_PARTS", hot)
    rng = random.Random(13)
    texts = [None, "", " ", "a b", "A  b", "a b c d e"]
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 200))]
        for _ in range(12):
            texts.append(" ".join(words))
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if root[a] != root[b] and jaccard(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    found = {r.id: r.component for r in near_copies.groups(helpers.documents(spark, texts)).collect()}
    assert found == dict(enumerate(root)) and len(set(root)) > 14


def test_rows_of_one_id_are_one_node(spark):
    words = " ".join(f"w{i}" for i in range(60))
    df = helpers.documents(spark, ["own text of nothing else here", words, words]).withColumn("doc_id", F.expr("greatest(doc_id, 1)"))
    assert {(r.id, r.component) for r in near_copies.groups(df).collect()} == {(1, 1), (2, 1)}


def test_bands_do_not_depend_on_parts(monkeypatch):
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 500, np.uint64))
    whole = near_copies.bands_of(hashes, *near_copies.permutations())
    monkeypatch.setattr(near_copies, "PART", 7)
    assert near_copies.bands_of(hashes, *near_copies.permutations()) == whole and len(whole) == near_copies.BANDS


def test_a_pair_that_only_fingerprints_bring_together(spark):
    """Alike to 0.8 exactly, in no common band, with one fingerprint."""
    rng = random.Random(1078)
    words = ["a"] * 200 + [f"w{rng.randrange(10**6)}" for _ in range(44)]
    copy = [*words[:222], "x12", *words[223:]]
    texts = [" ".join(words), " ".join(copy), "an own text that stays", " ".join(["a"] * 200 + [f"y{i}" for i in range(44)])]
    assert jaccard(shingles(texts[0]), shingles(texts[1])) == 0.8
    bands = [set(near_copies.bands_of(near_copies.shingles_of(t), *near_copies.permutations())) for t in texts]
    assert not bands[0] & bands[1]
    prints = [simhash.fingerprint(simhash.shingle_hashes(simhash.words_of(t), 3)) for t in texts]
    assert prints[0] == prints[1] == prints[3]  # so the last one is a candidate too, but is not alike
    assert {r.doc_id for r in simhash.drop_near_duplicates(helpers.documents(spark, texts)).collect()} == {0, 2, 3}
