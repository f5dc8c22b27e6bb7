import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from corpusmill.operators import repo_stats, rollup
from corpusmill.schemas import PROGRESS, REPO
from corpusmill.sinks import tables
from corpusmill.sources import state


def test_name_sets_in_any_layout(spark, tmp_path):
    words = ["a/b", 'quote"d', "back\\slash", "é"]
    for layout in (None, 2):
        path = tmp_path / f"seen{layout}.json"
        path.write_text(json.dumps(words, indent=layout))
        assert sorted(r.name for r in state.read_names(spark, str(path)).collect()) == sorted(words)
    assert state.read_names(spark, str(tmp_path / "none.json")).count() == 0


def test_summary_document(spark, tmp_path):
    path = tmp_path / "counts.json"
    path.write_text(json.dumps({"total_tokens": 5, "repos": {"a/b": {"tokens": 5, "files_processed": 2}, "c/d": {}}}, indent=2))
    got = sorted(tuple(r) for r in state.read_token_counts(spark, str(path)).collect())
    assert got == [("a/b", 5, 2), ("c/d", 0, 0)]
    path.write_text("{broken")
    assert state.read_token_counts(spark, str(path)).count() == 0
    assert state.read_token_counts(spark, str(tmp_path / "none")).count() == 0


def test_written_summary_is_one_document(spark, tmp_path):
    rows = [(f"p{i:03d}/é\"{i}", i, 1) for i in range(50)]
    table = spark.createDataFrame(rows, "project_name string, tokens long, files_processed long")
    out = tmp_path / "summary"
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else one part
    try:
        tables.write_summary(table, str(out))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    document = json.loads(text)
    assert document["total_repos"] == 50 and document["total_tokens"] == sum(range(50))
    assert document["repos"] == {n: {"tokens": t, "files_processed": f} for n, t, f in rows}
    assert len(list(out.glob("part-*"))) > 1
    totals, repos = state.read_summary(spark, str(out))
    assert sorted(tuple(r) for r in repos.collect()) == sorted(rows)
    assert tuple(totals.first()) == (sum(range(50)), 50, 50)
    assert sorted(tuple(r) for r in state.read_token_counts(spark, str(out)).collect()) == sorted(rows)


def test_summary_is_rewritten_only_if_wanted_and_needed(spark, tmp_path):
    table = spark.createDataFrame([("a", 3, 1)], "project_name string, tokens long, files_processed long")
    totals = rollup.summary_totals(table)
    other = totals.withColumn("total_tokens", F.lit(4).cast("long"))
    out = str(tmp_path / "s")
    assert not tables.update_summary(table, rollup.reconcile(totals, totals), out, update=True)
    assert not tables.update_summary(table, rollup.reconcile(totals, other), out, update=False)
    assert tables.update_summary(table, rollup.reconcile(totals, other), out, update=True)
    row = rollup.reconcile(totals, other).first()
    assert (row.tokens_diff, row.tokens_match, row.files_match) == (-1, False, True)


def test_defaults_fill_only_what_is_missing(spark, tmp_path):
    path = tmp_path / "progress.json"
    path.write_text('{"total_tokens": 7, "current_min_stars": 200}\n{"total_tokens": 8}\n')
    defaults = {"current_min_stars": F.lit(5000), "search_queries_completed": F.array().cast("array<string>")}
    rows = state.read_state(spark, str(path), PROGRESS, defaults).orderBy("total_tokens").collect()
    assert [(r.total_tokens, r.current_min_stars, r.search_queries_completed) for r in rows] == [(7, 200, []), (8, 5000, [])]


def test_corrupt_chunk(spark, tmp_path):
    import pytest

    from corpusmill.schemas import FILE_CHUNK

    row = [("a/b", "x.py", 1, "h", 1, "/x.py")]
    spark.createDataFrame(row, FILE_CHUNK).coalesce(1).write.parquet(str(tmp_path / "c"))
    (tmp_path / "c" / "part-bad.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        state.read_chunks(spark, str(tmp_path / "c")).collect()
    assert state.read_chunks(spark, str(tmp_path / "c"), skip_corrupt=True).count() == 1


def record(spark, rows):
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in REPO.fields if f.name not in ("full_name", "cloned_at", "stars")]
    df = spark.createDataFrame(rows, "full_name string, t string, stars long")
    return df.select("full_name", F.col("t").cast("timestamp_ntz").alias("cloned_at"), "stars", *cols).select(*REPO.fieldNames())


def test_upsert_last_write_wins(spark):
    old = record(spark, [("a", "2024-01-01", 1), ("b", "2024-01-05", 2), ("c", "2024-01-01", 3)])
    new = record(spark, [("a", "2024-01-02", 10), ("b", "2024-01-01", 20), ("c", "2024-01-01", 30), ("d", "2024-01-01", 40)])
    got = {r.full_name: r.stars for r in repo_stats.upsert_repos(old, new).collect()}
    assert got == {"a": 10, "b": 2, "c": 30, "d": 40}


def test_corrupt_chunks_are_named(spark, tmp_path):
    path = str(tmp_path / "chunks")
    spark.range(3).selectExpr(
        "'p' AS project_name", "'f' AS relative_path", "id AS file_size", "'h' AS sha256", "id AS token_count", "'a' AS absolute_path"
    ).coalesce(1).write.parquet(path)
    assert state.corrupt_chunks(spark, path).count() == 0
    (tmp_path / "chunks" / "part-9.parquet").write_bytes(b"PAR1 broken")
    found = state.corrupt_chunks(spark, path).collect()
    assert [r.file.rsplit("/", 1)[1] for r in found] == ["part-9.parquet"] and found[0].error
    assert state.read_chunks(spark, path, skip_corrupt=True).count() == 3


def test_damage_costs_its_row_group_only(spark, tmp_path):
    """Chunks with a broken page, a broken footer, a missing column, and sound ones."""
    folder = tmp_path / "chunks"
    folder.mkdir()

    def chunk(name, drop=()):
        columns = {
            "project_name": [f"p/{name}"] * 300,
            "relative_path": [f"{i}-{i * 7919 % 1009}.py" for i in range(300)],
            "file_size": list(range(300)),
            "sha256": [f"{i:064x}" for i in range(300)],
            "token_count": [i % 7 for i in range(300)],
            "absolute_path": [f"/{i}" for i in range(300)],
        }
        table = pa.table({k: v for k, v in columns.items() if k not in drop})
        path = folder / f"{name}.parquet"
        pq.write_table(table, path, row_group_size=100, compression="snappy", write_page_checksum=True)
        return path

    chunk("sound"), chunk("narrow", drop=["token_count"])
    page = chunk("page")
    place = pq.ParquetFile(page).metadata.row_group(1).column(3)
    with open(page, "r+b") as handle:  # in the middle of the second row group's hashes
        handle.seek(place.data_page_offset + place.total_compressed_size // 2)
        handle.write(b"\xff" * 64)
    footer = chunk("footer")
    with open(footer, "r+b") as handle:
        handle.truncate(footer.stat().st_size - 20)
    (folder / "empty.parquet").write_bytes(b"")
    rows, damage = state.read_sound_chunks(spark, str(folder))
    found = {r.project_name: r["count"] for r in rows.groupBy("project_name").count().collect()}
    assert found == {"p/sound": 300, "p/narrow": 300, "p/page": 200}
    assert rows.filter("project_name = 'p/narrow' AND token_count IS NULL").count() == 300
    assert rows.filter("project_name = 'p/page' AND file_size BETWEEN 100 AND 199").isEmpty()
    named = sorted((r.file.rpartition("/")[2], r.row_group) for r in damage.collect())
    assert named == [("empty.parquet", -1), ("footer.parquet", -1), ("page.parquet", 1)]
    assert damage.filter("error = ''").isEmpty()


def test_projects_on_one_side_only(spark):
    schema = "project_name string, tokens long, files_processed long"
    actual = spark.createDataFrame([("a", 5, 1), ("b", 7, 2), ("n", None, 1)], schema)
    expected = spark.createDataFrame([("b", 7, 3), ("c", 1, 1), ("n", None, 1)], schema)
    found = {r.project_name: tuple(r)[1:] for r in rollup.reconcile_projects(actual, expected).collect()}
    assert found == {
        "a": ("actual", None, 5, 5, False, None, 1, 1, False),
        "b": ("both", 7, 7, 0, True, 3, 2, -1, False),
        "c": ("expected", 1, None, -1, False, 1, None, -1, False),
        "n": ("both", None, None, 0, True, 1, 1, 0, True),
    }
