import json
import os

from corpusmill.plans.upkeep import extend_clone_list, read_clone_list, update_token_counts


def hits(spark, rows):
    return spark.createDataFrame(rows, "full_name string, clone_url string, stars long, seq long")


def test_clone_list_grows_by_new_names_only(spark, tmp_path):
    path = str(tmp_path / "list")
    cloned = spark.createDataFrame([("have/it",)], "full_name string")
    assert read_clone_list(spark, path).count() == 0
    first = hits(spark, [("a/a", "u", 5, 2), ("a/a", "u", 9, 1), ("have/it", "u", 1, 3), ("b/b", "u", 2, 4)])
    assert extend_clone_list(first, path, cloned, ["seq"]).count() == 2
    again = hits(spark, [("a/a", "u", 100, 1), ("c/c", "u", 3, 2)])
    assert extend_clone_list(again, path, cloned, ["seq"]).count() == 1
    assert extend_clone_list(again, path, cloned, ["seq"]).count() == 0
    got = {r.full_name: r.stars for r in read_clone_list(spark, path).collect()}
    assert got == {"a/a": 9, "b/b": 2, "c/c": 3}


def document(folder):
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return json.loads("".join(open(os.path.join(folder, f)).read() for f in parts))


def test_token_counts_are_carried_on(spark, tmp_path):
    root, summary = tmp_path / "r", str(tmp_path / "summary")
    (root / "o_one").mkdir(parents=True)
    (root / "o_one" / "a.txt").write_text("one two")
    (root / "o_none").mkdir()
    update_token_counts(spark, str(root), summary)
    assert document(summary) == {
        "total_tokens": 2, "total_repos": 2, "total_files": 1,
        "repos": {"o/none": {"tokens": 0, "files_processed": 0}, "o/one": {"tokens": 2, "files_processed": 1}},
    }
    (root / "o_one" / "b.txt").write_text("not counted again")
    (root / "o_two").mkdir()
    (root / "o_two" / "c.py").write_text("x = 1")
    update_token_counts(spark, str(root), summary)
    got = document(summary)
    assert (got["total_tokens"], got["total_repos"], got["total_files"]) == (5, 3, 2)
    assert got["repos"]["o/two"] == {"tokens": 3, "files_processed": 1}
