import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith

from corpusmill import storage
from corpusmill.sources import code_tree, predicates, tree


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("repos")
    files = {
        "a_one/x.py": b"x = 1",
        "a_one/__init__.py": b"",
        "a_one/.git/objects/pack": b"\0" * 900,
        "a_one/src/deep/er/y.py": b"y",
        "a_one/src/data.bin": b"\xff" * 300,
        "b_two/src/z.py": b"zz",
        "b_two/LICENSE": b"text",
        ".hidden/x.py": b"no",
        **{f"c_many/f{i}.py": b"m" * (i % 7) for i in range(120)},
        **{f"c_many/sub{i % 9}/g{i}.txt": b"n" for i in range(60)},
    }
    for path, content in files.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    (root / "d_empty").mkdir()
    (root / "top.py").write_bytes(b"not in a project")
    return str(root), {k: v for k, v in files.items() if not k.startswith(".hidden")}


def rows_of(df):
    rows = {f"{r.dir_name}/{r.file_path}": r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


@pytest.mark.parametrize("part_bytes", [1 << 28, 200_000, 20_000])
def test_all_files_with_any_size_of_parts(spark, corpus, part_bytes):
    root, files = corpus
    df = code_tree.load_tree(spark, root, ["dir_name", "file_path", "name", "size", "content"], part_bytes=part_bytes)
    rows = rows_of(df)
    assert {k: bytes(r.content) for k, r in rows.items()} == files
    assert all(r.size == len(r.content) and r.name == r.file_path.rpartition("/")[2] for r in rows.values())
    assert (df.rdd.getNumPartitions() > 20) == (part_bytes == 20_000)


def test_equal_to_the_plain_scan(spark, corpus):
    root, _ = corpus
    assert sorted(code_tree.load_tree(spark, root).collect()) == sorted(tree.scan_tree(spark, root).collect())


def test_filters_give_what_spark_gives(spark, corpus):
    root, _ = corpus
    walk = code_tree.walk_folders(spark, root, part_bytes=50_000)
    plain = tree.scan_tree(spark, root)
    path, name = F.col("file_path"), F.col("name")
    for condition in (
        name.endswith(".py"),
        ~path.contains(".git"),
        path.startswith("src/de") & (F.col("size") <= 5 * 2**20),
        F.col("dir_name").isin("a_one", "nowhere") & ~path.startswith("src"),
        (F.col("dir_name") != "c_many") & (F.col("size") > 0),
        path == "src/z.py",
        F.length("name") > 7,
        (F.col("size") > 4) | name.startswith("x"),
        ~(F.col("size") > 3),
        path.isNull(),
        path > "g",
    ):
        found = code_tree.load_tree(spark, root, walk=walk).filter(condition)
        assert sorted(found.collect()) == sorted(plain.filter(condition).collect()), condition
    assert code_tree.load_tree(spark, root, walk=walk).count() == plain.count()  # nothing kept of what was pushed


def reader(spark, root, walk, columns, filters):
    schema = code_tree.T.StructType([f for f in code_tree.SCHEMA.fields if f.name in columns])
    made = code_tree.TreeReader(storage.qualified(spark, root), storage.qualified(spark, walk), schema)
    left = list(made.pushFilters(filters))
    return made, left


def test_only_what_passes_is_opened_and_listed(spark, corpus, monkeypatch):
    root, files = corpus
    walk = code_tree.walk_folders(spark, root)
    opened, listed = [], []
    read, listing = tree.read_bytes, tree.list_directory
    monkeypatch.setattr(tree, "read_bytes", lambda path, clients: opened.append(path) or read(path, clients))
    monkeypatch.setattr(tree, "list_directory", lambda path, clients: listed.append(path) or listing(path, clients))

    def run(columns, *filters):
        opened.clear(), listed.clear()
        made, left = reader(spark, root, walk, columns, list(filters))
        rows = [r for part in made.partitions() for b in made.read(part) for r in b.to_pylist()]
        return rows, left

    every = ["dir_name", "file_path", "size", "content"]
    rows, left = run(every, StringEndsWith(("name",), ".py"), Not(StringContains(("file_path",), ".git")), LessThanOrEqual(("size",), 3))
    assert left == [] and len(opened) == len(rows) == sum(k.endswith(".py") and len(v) <= 3 for k, v in files.items())
    assert not any(".git" in p for p in listed)
    rows, _ = run(every[:3])
    assert len(rows) == len(files) and opened == []
    rows, _ = run(every, EqualTo(("dir_name",), "b_two"), StringStartsWith(("file_path",), "src/"))
    assert [bytes(r["content"]) for r in rows] == [b"zz"] and len(opened) == 1
    assert [p.rpartition("repos")[2].split("/", 1)[1] for p in listed] == ["b_two", "b_two/src"] or len(listed) == 2
    odd = GreaterThan(("file_path",), "g")
    assert run(every[:3], odd)[1] == [odd]


def test_predicates_as_in_sql():
    row = {"a": "xyz", "b": None, "n": 3}
    cases = [
        (EqualTo(("a",), "xyz"), True), (EqualTo(("b",), "x"), None), (Not(EqualTo(("b",), "x")), None), (IsNull(("b",)), True),
        (In(("a",), ("q", None)), None), (In(("a",), ("xyz", None)), True), (Not(In(("n",), (1, 2))), True), (GreaterThan(("n",), 3), False),
        (StringContains(("a",), "y"), True), (StringStartsWith(("b",), ""), None), (Not(StringEndsWith(("a",), "z")), False),
    ]
    for f, wanted in cases:
        assert predicates.verdict(f, row) is wanted, f
    for f in (EqualTo(("p",), "src/x"), In(("p",), ("src/x", None)), StringStartsWith(("p",), "src/x"), StringStartsWith(("p",), "s")):
        assert predicates.may_hold(f, "p", "src/") and predicates.may_hold(f, "q", "doc/") and predicates.may_hold(f, "p", "doc/") is False
    assert not predicates.may_hold(IsNull(("p",)), "p", "src/") and not predicates.may_hold(Not(StringStartsWith(("p",), "s")), "p", "src/")


def test_empty_trees_and_wrong_columns(spark, tmp_path):
    (tmp_path / "a_b").mkdir()
    assert code_tree.load_tree(spark, str(tmp_path), ["dir_name", "content"]).collect() == []
    with pytest.raises(Exception, match="no columns"):
        reader(spark, str(tmp_path), str(tmp_path), [], [])[0].__class__("r", "w", code_tree.T.StructType().add("other", "string"))
