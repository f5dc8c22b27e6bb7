import hashlib
import random
from bisect import bisect_left
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, ring_shards
from tests import compare
from tests.llm import helpers


def hashes(text):
    digest = hashlib.md5((text or "").encode()).hexdigest()
    return int(digest[:15], 16), int(digest[15:30], 16)


def ring(shards, nodes):
    return sorted((hashes(f"shard-{s}-{v}")[0], s) for s in range(shards) for v in range(nodes))


def plain_places(texts, shards, nodes, slack):
    """The rule, step by step: own keys first, then walk on clockwise, round after round."""
    points = ring(shards, nodes)
    n = len(texts)
    if slack:
        capacity = [-(-n * (1 + slack) // shards)] * shards
    else:
        capacity = [n // shards + (s < n % shards) for s in range(shards)]
    own, over = [[] for _ in range(shards)], [deque() for _ in points]
    node = {i: bisect_left(points, (hashes(t)[0], -1)) % len(points) for i, t in enumerate(texts)}
    for i in sorted(node, key=lambda i: (hashes(texts[i])[1], i)):
        home = points[node[i]][1]
        (own[home] if len(own[home]) < capacity[home] else over[node[i]]).append(i)
    room = {s: int(capacity[s]) - len(own[s]) for s in range(shards)}
    spare, seen = [], Counter()
    for _, s in points:
        spare.append(room[s] // nodes + (seen[s] < room[s] % nodes))
        seen[s] += 1
    for quiet in range(len(points)):  # a point that nothing passes: one lap from behind it leaves none waiting
        found, left, queue = {i: s for s in range(shards) for i in own[s]}, list(spare), deque()
        for j in range(quiet + 1, quiet + 1 + len(points)):
            j %= len(points)
            queue.extend(over[j])
            while left[j] and queue:
                found[queue.popleft()] = points[j][1]
                left[j] -= 1
        if not queue:
            return found
    raise AssertionError


def made(rng, n, copies):
    texts = [f"text {rng.randrange(10**6)}" for _ in range(n)]
    return texts + ["the hot text"] * copies


def placed(df, **options):
    return ring_shards.place_documents(df, **options).collect()


@pytest.mark.parametrize(("shards", "nodes", "slack", "copies"), [(7, 5, 0.0, 100), (40, 64, 0.0, 0), (7, 5, 0.25, 100), (1, 1, 0.0, 5), (9, 3, 1.5, 0)])
def test_places_by_the_rule(spark, shards, nodes, slack, copies):
    texts = [None, "", *made(random.Random(shards), 250, copies)]
    rows = placed(helpers.documents(spark, texts), shards=shards, nodes=nodes, slack=slack)
    wanted = plain_places(texts, shards, nodes, slack)
    assert {r.row.doc_id: r.shard for r in rows} == wanted and len(rows) == len(texts)
    counts = Counter(wanted.values())
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    if not slack:
        assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1


def test_equal_texts_stay_together_where_there_is_room(spark):
    rng = random.Random(1)
    texts = [f"t{rng.randrange(60)}" for _ in range(600)]
    rows = placed(helpers.documents(spark, texts), shards=4, slack=0.5)
    assert all(r.home == r.shard for r in rows) and len({(texts[r.row.doc_id], r.shard) for r in rows}) == len(set(texts))


def test_a_new_shard_moves_few(spark):
    texts = made(random.Random(2), 4000, 0)
    df = helpers.documents(spark, texts)
    before, after = ({r.row.doc_id: r for r in placed(df, shards=n, slack=0.1)} for n in (20, 21))
    moved = [i for i in before if before[i].shard != after[i].shard]
    homes = [i for i in before if before[i].home != after[i].home]
    assert all(after[i].home == 20 for i in homes) and len(homes) < 2 * len(texts) / 21
    assert len(moved) < 4 * len(texts) / 21


def test_only_dataframe_functions(spark):
    found = ring_shards.place_documents(helpers.documents(spark, ["a", "b", "c"]))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_odd_tables(spark):
    df = helpers.odd(spark, ["a b " * 8]).withColumn("slot", F.lit("own slot"))
    rows = placed(df, keep=["doc_id", "row", "slot"], shards=3)
    assert Counter(r.row.doc_id for r in rows) == Counter([0, 1, 2, 3, 3, None, 4, 5, 10])
    assert sorted(Counter(r.shard for r in rows).values()) == [3, 3, 3] and {r.row.slot for r in rows} == {"own slot"}
    sizes = {r.row.doc_id: (r.size, r.text_crc32) for r in rows}
    assert sizes[0] == sizes[1] == (16, 0) and sizes[2][0] == len(helpers.LONG) + 16
    assert placed(helpers.empty(spark)) == []


def test_query_equals_its_sql(spark, tmp_path):
    texts = [None, "", "é 日本", *made(random.Random(4), 700, 300)]
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, texts))
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    result = db.execute(queries.ORACLE["op12_ring_shards"])
    names = [d[0] for d in result.description]
    df = queries.op12_ring_shards(spark, sf)
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(names, result.fetchall())
