import random

import numpy as np
import pytest

from corpusmill.llm import decontaminate as D
from corpusmill.llm import queries
from tests.llm import helpers


def greedy_tiles(a, b, shortest):
    """Greedy string tiling as it is stated: always the longest match that is left."""
    free_a, free_b, tiles = [True] * len(a), [x >= 0 for x in b], []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return tiles
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False
        tiles.append((i, j, n))


def test_tiles_against_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        size = rng.choice([2, 3, 6])
        a = [rng.randrange(size) for _ in range(rng.randint(1, 20))]
        b = [rng.randrange(rng.choice([-1, 0]), size) for _ in range(rng.randint(1, 30))]
        shortest = rng.choice([1, 2, 3, 5])
        assert D.tile(np.array(a, np.int64), np.array(b, np.int64), shortest) == greedy_tiles(a, b, shortest)


ITEM = (
    "the quick brown fox jumps over the lazy dog while seven small birds sing a song about "
    "rivers and mountains that nobody has ever seen before in this quiet part of the world"
)


def shuffled(text, size=8):
    words = text.split()
    parts = [words[i : i + size] for i in range(0, len(words), size)]
    random.Random(1).shuffle(parts)
    return " ".join(" ".join(p) for p in parts)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(0, ITEM), (1, "two words"), (2, None), (3, "..."), (4, ITEM.upper()), (5, "a a a a a a a a a a")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_finds_copies_and_reordered_passages(spark, benchmark):
    clean = " ".join(f"w{i}" for i in range(300))
    half = " ".join(ITEM.split()[:12])
    texts = [ITEM, f"{clean} {shuffled(ITEM)} {clean}", clean, half, ITEM.replace(" ", ", ").upper(), "some two words", "two other words"]
    found = D.find_leaks(helpers.documents(spark, texts), benchmark)
    items = {r.row.doc_id: [(x.item, round(x.covered, 2)) for x in r.leaks] for r in found.collect()}
    assert items == {0: [(0, 1.0), (4, 1.0)], 1: [(0, 1.0), (4, 1.0)], 2: [], 3: [], 4: [(0, 1.0), (4, 1.0)], 5: [(1, 1.0)], 6: []}


def test_blocks_give_the_same(spark, benchmark, monkeypatch):
    df = helpers.odd(spark, [ITEM, shuffled(ITEM), "a " * 5000, "two words"])
    wanted = sorted(map(str, D.find_leaks(df, benchmark, keep=["doc_id"]).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    assert sorted(map(str, D.find_leaks(df, benchmark, keep=["doc_id"]).collect())) == wanted


def test_odd_tables(spark, benchmark):
    found = D.find_leaks(helpers.odd(spark), benchmark)
    assert found.columns == ["row", "leaks"] and found.where("size(leaks) > 0").count() == 0 and found.count() == 8
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert D.find_leaks(helpers.odd(spark, [ITEM]), nothing).where("size(leaks) > 0").count() == 0
    assert D.find_leaks(helpers.empty(spark), benchmark).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    items = [" ".join(rng.choices("abcdefg", k=rng.randint(3, 25))) for _ in range(12)]
    texts = [" ".join(rng.choices("abcdefg", k=rng.randint(0, 40))) for _ in range(40)]
    texts += [f"{t} {shuffled(i, 6)}" for t, i in zip(texts, items, strict=False)]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, texts), benchmark=frame)
    for row in queries.op2_decontaminate(spark, sf).collect():
        wanted = []
        for name, item in enumerate(items):
            a = item.split()
            tiles = greedy_tiles([ord(x) for x in a], [ord(x) for x in texts[row.doc_id].split()], min(5, len(a)))
            if sum(n for _, _, n in tiles) / len(a) >= D.THRESHOLD:
                wanted.append(name)
        assert row["items"] == wanted and row.contaminated == bool(wanted)
