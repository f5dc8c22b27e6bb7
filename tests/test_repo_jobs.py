from pyspark.sql import functions as F

from corpusmill.operators import discovery as D
from corpusmill.operators import repo_stats
from corpusmill.plans.build import record_tree, stats_tree
from corpusmill.schemas import REPO


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content)


def tree(tmp_path):
    root = tmp_path / "repos"
    put(root, "a_one/x.py", b"x = 1")
    put(root, "a_one/.git/pack", b"\0" * 500)
    put(root, "a_one/big.bin", b"\0" * 300)
    put(root, "a_one/notes.md", b"two words")
    put(root, "b_two/LICENSE", b"text")
    (root / "c_empty").mkdir()
    return str(root)


def test_statistics_of_a_tree(spark, tmp_path, monkeypatch):
    root = tree(tmp_path)
    got = {r.dir_name: r for r in stats_tree(spark, root).collect()}
    assert set(got) == {"a_one", "b_two", "c_empty"}
    one = got["a_one"]
    assert (one.total_files, one.python_files, one.files_processed, one.tokens) == (3, 1, 2, 5)
    assert (one.size_bytes, one.files_deleted, one.bytes_freed) == (5 + 500 + 9, 1, 300)
    assert tuple(got["c_empty"])[1:] == (0,) * 7
    kept = {r.dir_name: r for r in stats_tree(spark, root, purge=False).collect()}
    assert kept["a_one"].total_files == 4 and kept["a_one"].files_deleted == 0


def test_only_countable_files_are_read(spark, tmp_path):
    listing = spark.createDataFrame(
        [("a", "x.py", 5), ("a", "y.bin", 5), ("a", "z.md", 10**9), ("a", "LICENSE", 3), ("a", "w.txt", 2 * 2**20)],
        "dir_name string, file_path string, size long",
    )
    assert [r.file_path for r in repo_stats.countable(listing).collect()] == ["x.py"]


def test_user_tokenizer_in_statistics(spark, tmp_path):
    def words(batches):
        for batch in batches:
            yield batch.str.split().str.len()

    got = {r.dir_name: r.tokens for r in stats_tree(spark, tree(tmp_path), tokenizer=words).collect()}
    assert got == {"a_one": 3 + 2, "b_two": 0, "c_empty": 0}


def test_records_of_a_tree(spark, tmp_path):
    root = tree(tmp_path)
    at = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    old = (0, 0, 99, 0, 0, 0, 0)
    rows = [("a/one", "u1", "p1", old, None, 7, 0, 0, None), ("gone/away", "u2", "p2", old, None, 3, 0, 0, None)]
    db = spark.createDataFrame(rows, REPO)
    records, totals = record_tree(spark, root, db, at=at, stored_tokens=F.lit(5).cast("long"))
    got = {r.full_name: r for r in records.collect()}
    assert set(got) == {"a/one", "gone/away", "b/two", "c/empty"}
    assert got["a/one"].stats.tokens == 5 and got["a/one"].url == "u1" and got["a/one"].stars == 7
    assert got["gone/away"].stats.tokens == 99 and got["b/two"].url == "unknown"
    assert totals.first().total_tokens == 104 and totals.first().drifted


LEVELS = [50, 20, 10]


def step(spark, log, done, current):
    """Two queries with stars in their text and one without, as the crawler makes them."""

    def generate(level):
        rows = [(f"a stars:>={level}", "topic"), (f"b stars:>={level}", "topic"), ("size:>1000", "size")]
        return spark.createDataFrame(rows, "query string, family string")

    pages = spark.createDataFrame(log, "query string, page long, found long, new long, threshold long")
    finished = spark.createDataFrame(done, "query string, threshold long")
    rows = D.crawl_step(generate, pages, finished, LEVELS, current).collect()
    return sorted((r.query, r.next_page, r.current_min_stars, r.expanded) for r in rows)


def test_crawl_goes_on_where_it_stopped(spark):
    log = [("a stars:>=20", 1, 100, 3, 20), ("b stars:>=20", 1, 0, 0, 20), ("size:>1000", 9, 0, 0, 50)]
    assert step(spark, log, [], 20) == [("a stars:>=20", 2, 20, False), ("size:>1000", 1, 20, False)]
    assert step(spark, [], [("size:>1000", 20), ("b stars:>=20", 50)], 20) == [("a stars:>=20", 1, 20, False), ("b stars:>=20", 1, 20, False)]


def test_three_expansions_in_a_row(spark):
    """The log grows and is never emptied; each call goes on from what the one before said."""
    log, done, now = [], [], 50
    for following in (20, 10):
        todo = step(spark, log, done, now)
        assert [(q, page, level, new) for q, page, level, new in todo] == [
            (q, 1, now, False) for q in (f"a stars:>={now}", f"b stars:>={now}", "size:>1000")
        ]
        log += [(f"a stars:>={now}", 1, 0, 0, now), (f"b stars:>={now}", 10, 5, 5, now)]
        assert step(spark, log, done, now) == [("size:>1000", 1, now, False)]
        done += [("size:>1000", now)]
        grown = step(spark, log, done, now)
        assert grown == [(q, 1, following, True) for q in (f"a stars:>={following}", f"b stars:>={following}", "size:>1000")]
        now = grown[0][2]
    log += [(q, 10, 1, 1, 10) for q in ("a stars:>=10", "b stars:>=10", "size:>1000")]
    assert step(spark, log, done, 10) == []  # no lower threshold
    assert step(spark, log, done, 7) != []  # a threshold that is no level never expands
