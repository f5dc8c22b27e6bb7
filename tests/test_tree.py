import json
import os
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard

from corpusmill.operators import extract, packing, repo_stats
from corpusmill.plans.build import build_dataset, count_tree
from corpusmill.sinks import shards, tables
from corpusmill.sources import state, tree

MIB = 1024 * 1024


def put(root, path, content=b"x = 1\n"):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as handle:
        handle.write(content)


@pytest.fixture
def root(tmp_path):
    root = str(tmp_path / "cloned")
    for path in ("__init__.py", "_priv/m.py", ".hid/n.py", "deep/a/b/c/d.py"):
        put(root, f"o_p/{path}")
    put(root, "o_p/empty.py", b"")
    put(root, "o_p/exact.py", b"a" * (5 * MIB))
    put(root, "o_p/over.py", b"a" * (5 * MIB + 1))
    put(root, "o_p/nul.py", b"a\0b")
    put(root, "o_p/bad.py", b"a \xff b")
    put(root, "o_p/crlf.py", b"a\r\nb\r\n")
    put(root, "o_p/.git/h.py")
    put(root, "o_p/.github/w.py")
    put(root, "o_p/docs.gitbook/d.py")
    put(root, "o_p/X.PY")
    put(root, "o_p/notes.txt", b"one two")
    put(root, "u_u.github.io/site.py")
    put(root, ".hidden/h.py")
    put(root, "a_b_c/m.py")
    os.makedirs(os.path.join(root, "e_empty"))
    put(root, "loose.py")
    os.symlink(root, os.path.join(root, "o_p", "loop"))
    return root


def names(df):
    return sorted((r.dir_name, r.file_path) for r in df.collect())


def walked(root):
    found = []
    for project in os.listdir(root):
        top = os.path.join(root, project)
        if os.path.isdir(top) and not project.startswith("."):
            for folder, _, files in os.walk(top):
                found += [(project, os.path.relpath(os.path.join(folder, f), top)) for f in files]
    return sorted(found)


@pytest.mark.parametrize("budget", [1, 3, 20_000])
def test_scan_finds_every_file(spark, root, budget):
    listing = tree.scan_tree(spark, root, budget=budget)
    assert names(listing) == walked(root)
    sizes = {(r.dir_name, r.file_path): r.size for r in listing.collect()}
    assert sizes["o_p", "empty.py"] == 0 and sizes["o_p", "over.py"] == 5 * MIB + 1


def test_skipped_directories_change_no_result(spark, root):
    from pyspark.sql import functions as F

    from corpusmill.functions import paths

    whole, pruned = tree.scan_tree(spark, root), tree.scan_tree(spark, root, skip=".git", budget=2)
    kept = whole.filter(~paths.under_git_like(F.col("dir_name"), F.col("file_path")))
    assert names(pruned) == names(kept) and kept.count() < whole.count()


def test_projects(spark, root):
    got = {r.dir_name: r.project_name for r in tree.list_projects(spark, root).collect()}
    assert got == {"o_p": "o/p", "u_u.github.io": "u/u.github.io", "a_b_c": "a/b_c", "e_empty": "e/empty"}
    assert sorted(r.full_name for r in state.cloned_set(spark, root).collect()) == sorted(got.values())


def test_strict_metadata(spark, root):
    listing = tree.scan_tree(spark, root)
    files = tree.read_content(extract.candidates(listing), root)
    got = {r.relative_path: r for r in extract.extract_metadata(files, root=root).collect()}
    assert sorted(got) == [
        ".hid/n.py", "__init__.py", "_priv/m.py", "crlf.py", "deep/a/b/c/d.py", "empty.py", "exact.py", "m.py",
    ]
    assert got["empty.py"].token_count == 0
    assert got["m.py"].project_name == "a/b_c"
    assert got["m.py"].absolute_path == f"{root}/a_b_c/m.py"
    assert got["crlf.py"].file_size == 6


def test_lossy_counts(spark, root):
    got = {r.project_name: (r.tokens, r.files_processed) for r in count_tree(spark, root).collect()}
    files = ["__init__.py", "_priv/m.py", ".hid/n.py", "deep/a/b/c/d.py", "exact.py", "nul.py", "bad.py", "crlf.py",
             "X.PY", "notes.txt"]
    assert got["o/p"] == (3 * 5 + 1 + 3 + 2 + 2 + 2, len(files))
    assert got["u/u.github.io"] == (0, 0) and got["e/empty"] == (0, 0) and got["a/b_c"] == (3, 1)


def test_counting_goes_on_where_it_stopped(spark, root):
    first = count_tree(spark, root)
    again = count_tree(spark, root, already=first.filter("project_name <> 'a/b_c'"))
    assert [tuple(r) for r in again.collect()] == [("a/b_c", 3, 1)]


def test_repo_stats_count_git_internals_but_not_dropped_files(spark, tmp_path):
    root = str(tmp_path / "r")
    put(root, "o_p/a.py", b"a b")
    put(root, "o_p/.git/objects/x.bin", b"zz")
    put(root, "o_p/x.bin", b"zzzz")
    put(root, "o_p/README", b"text")
    put(root, "o_p/n.md", b"one two three")
    files = tree.read_content(tree.scan_tree(spark, root), root)
    got = repo_stats.repo_stats(files).first().asDict()
    assert got == {
        "dir_name": "o_p", "total_files": 4, "python_files": 1, "tokens": 5, "size_bytes": 22,
        "files_deleted": 1, "bytes_freed": 4, "files_processed": 2,
    }
    kept = repo_stats.repo_stats(files, purge=False).first()
    assert (kept.total_files, kept.files_deleted, kept.size_bytes) == (5, 0, 26)


def test_flat_names(spark):
    rows = [("p", "b/x.py"), ("p", "a/x.py"), ("p", "y.py"), ("q", "a/x.py")]
    df = spark.createDataFrame(rows, "project_name string, file_path string")
    got = {(r.project_name, r.file_path): r.flat_name for r in extract.flat_names(df).collect()}
    assert got["p", "a/x.py"] == "x.py" and got["q", "a/x.py"] == "x.py" and got["p", "y.py"] == "y.py"
    assert got["p", "b/x.py"].startswith("x_") and got["p", "b/x.py"].endswith(".py")
    assert len({v for (p, _), v in got.items() if p == "p"}) == 3


# --- archives -------------------------------------------------------------------------


def members(folder):
    found = {}
    for name in sorted(os.listdir(folder)):
        assert name.endswith(".tar.zst"), name
        with open(os.path.join(folder, name), "rb") as raw:
            with zstandard.ZstdDecompressor().stream_reader(raw) as packed:
                with tarfile.open(fileobj=packed, mode="r|") as tar:
                    found[name] = [(m.name, tar.extractfile(m).read()) for m in tar]
    return found


@pytest.fixture
def corpus(tmp_path):
    root = str(tmp_path / "repos")
    for repo in ("repo_a", "repo_b"):
        for i in range(5):
            put(root, f"{repo}/file_{i}.py", f"print('Hello from {repo} file {i}')\n".encode() * 10)
    return root


def test_whole_build(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    expected = str(tmp_path / "token_counts.json")
    tokens = 10 * 10 * 12
    with open(expected, "w") as handle:
        json.dump({"total_tokens": tokens + 1, "total_repos": 2, "total_files": 10,
                   "repos": {"repo_a": {"tokens": tokens // 2, "files_processed": 5},
                             "repo_b": {"tokens": tokens // 2 + 1, "files_processed": 5}}}, handle)
    built = build_dataset(
        spark, corpus, out, expected=expected, update_counts=True, rows_per_chunk=4, target=1000, min_size=500, max_size=2000
    )
    assert built.index.count() == built.final.count() == 10
    assert built.pending.count() == 0
    assert built.index.filter("shard_id IS NOT NULL").count() == 0
    totals = built.totals.first()
    assert (totals.total_files, totals.total_repos, totals.total_bytes) == (10, 2, 2 * 5 * 10 * 34)
    check = built.reconciled.first()
    assert totals.total_tokens == tokens
    assert check.files_match and not check.tokens_match and check.tokens_diff == -1
    archives = members(f"{out}/shards")
    manifest = built.final.orderBy("shard_id", "project_name", "file_path").collect()
    listed = [(r.shard_id, f"{r.project_name}/{r.file_path}") for r in manifest]
    assert listed == [(a[6:11], name) for a, held in archives.items() for name, _ in held]
    assert [name for _, name in listed] == sorted(name for _, name in listed)
    contents = {name: body for held in archives.values() for name, body in held}
    assert contents["repo/a/file_3.py"] == b"print('Hello from repo_a file 3')\n" * 10
    assert built.summary_updated
    parts = sorted(f for f in os.listdir(f"{out}/token_counts") if f.startswith("part-"))
    document = json.loads("".join(open(f"{out}/token_counts/{f}").read() for f in parts))
    assert document["total_tokens"] == tokens
    assert document["repos"]["repo/a"] == {"tokens": tokens // 2, "files_processed": 5}


def assigned(spark, corpus):
    files = tree.read_content(extract.candidates(tree.scan_tree(spark, corpus)), corpus)
    index = extract.build_index(extract.extract_metadata(files, root=corpus))
    return packing.assign_shards(index, target=1000, min_size=500, max_size=2000)


def test_shards_are_written_once_and_byte_stable(spark, corpus, tmp_path):
    archives, manifest = str(tmp_path / "a"), str(tmp_path / "m")
    rows = assigned(spark, corpus)
    first = shards.write_shards(rows, root=corpus, archives=archives, manifest=manifest).collect()
    before = {n: (os.stat(f"{archives}/{n}").st_mtime_ns, open(f"{archives}/{n}", "rb").read()) for n in os.listdir(archives)}
    again = shards.write_shards(rows, root=corpus, archives=archives, manifest=manifest).collect()
    assert sorted(first) == sorted(again)
    assert {n: os.stat(f"{archives}/{n}").st_mtime_ns for n in os.listdir(archives)} == {n: t for n, (t, _) in before.items()}
    # an archive that is lost is written again, the same to the byte
    os.remove(f"{archives}/shard_00001.tar.zst")
    third = shards.write_shards(rows, root=corpus, archives=archives, manifest=manifest).collect()
    assert sorted(third) == sorted(first)
    assert open(f"{archives}/shard_00001.tar.zst", "rb").read() == before["shard_00001.tar.zst"][1]


def test_missing_files_are_left_out(spark, corpus, tmp_path):
    rows = assigned(spark, corpus)
    kept = tables.write_index(rows, str(tmp_path / "index"))
    os.remove(f"{corpus}/repo_a/file_2.py")
    got = shards.write_shards(kept, root=corpus, archives=str(tmp_path / "a"), manifest=str(tmp_path / "m"))
    assert got.count() == 9 and got.filter("file_path = 'file_2.py' AND project_name = 'repo/a'").count() == 0
    listing = tree.scan_tree(spark, corpus)
    gone = extract.missing_files(kept, listing).collect()
    assert [(r.project_name, r.file_path) for r in gone] == [("repo/a", "file_2.py")]
    assert extract.existing_files(kept, listing).count() == 9


SHARD_SCHEMA = pa.schema([("project_name", pa.string()), ("file_path", pa.string()), ("shard_id", pa.string())])


@pytest.fixture
def rows_to_archive(monkeypatch):
    def content(path, clients):
        if path == "boom":
            raise ValueError("broken")
        return b"ok"

    monkeypatch.setattr(shards, "READ_PAUSE", 0)
    monkeypatch.setattr(shards, "read_bytes", content)
    return pa.RecordBatch.from_pydict(
        {
            "project_name": ["p"] * 5,
            "file_path": list("abcde"),
            "shard_id": ["00000", "00000", "00001", "00001", "00002"],
            "_member": list("abcde"),
            "_location": ["x", "x", "x", "boom", "x"],
        }
    )


def shard_job(folder):
    return shards.TarZstWriter(*(str(folder / part) for part in ("a", "m", "f")), 3, SHARD_SCHEMA)


def everything(folder):
    """Archives, manifest rows by shard, and errors by file; nothing else may be there."""
    found = sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())
    archives = [p[2:] for p in found if p.startswith("a/")]
    listed = {p.split("=")[1][:5]: pq.ParquetFile(folder / p).read().column("file_path").to_pylist() for p in found if p.startswith("m/")}
    errors = {}
    for p in found:
        if p.startswith("f/"):
            errors |= {r["file_path"]: r[shards.ERROR] for r in pq.ParquetFile(folder / p).read().to_pylist()}
    assert not any(".tmp" in p for p in found)
    return archives, listed, errors


def test_a_bad_file_costs_that_file_only(rows_to_archive, tmp_path):
    job = shard_job(tmp_path)
    message = job.write(iter([rows_to_archive.slice(0, 1), rows_to_archive.slice(1)]))
    assert not [p for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(".")]  # nothing before the commit
    job.commit([message, None])
    archives, listed, errors = everything(tmp_path)
    assert archives == [f"shard_0000{i}.tar.zst" for i in range(3)]
    assert listed == {"00000": ["a", "b"], "00001": ["c"], "00002": ["e"]} and errors == {"d": "ValueError: broken"}


def test_a_shard_that_cannot_be_written_is_left_out(rows_to_archive, monkeypatch, tmp_path):
    def add(self, name, content):
        if name == "b":
            raise OSError("no space")
        whole(self, name, content)

    whole = shards._Shard.add
    monkeypatch.setattr(shards._Shard, "add", add)
    job = shard_job(tmp_path)
    job.commit([job.write(iter([rows_to_archive.slice(0, 1), rows_to_archive.slice(1)]))])
    archives, listed, errors = everything(tmp_path)
    assert archives == ["shard_00001.tar.zst", "shard_00002.tar.zst"] and set(listed) == {"00001", "00002"}
    assert errors == {"a": "shard: OSError: no space", "b": "shard: OSError: no space", "d": "ValueError: broken"}


def test_a_failed_task_leaves_nothing(rows_to_archive, tmp_path):
    def batches():
        yield rows_to_archive
        raise OSError("cannot read on")

    job = shard_job(tmp_path)
    with pytest.raises(OSError):
        job.write(batches())
    assert everything(tmp_path) == ([], {}, {})


def test_a_task_killed_in_the_middle_leaves_nothing(rows_to_archive, tmp_path):
    job = shard_job(tmp_path)

    def batches():
        yield rows_to_archive
        os._exit(9)

    child = os.fork()
    if child == 0:
        job.write(batches())
        os._exit(0)
    assert os.waitpid(child, 0)[1] != 0
    assert [p for p in tmp_path.rglob("*.tmp")]  # what the lost task has left
    job.commit([job.write(iter([rows_to_archive.slice(0, 2)]))])
    assert everything(tmp_path) == (["shard_00000.tar.zst"], {"00000": ["a", "b"]}, {})
    other = shard_job(tmp_path)
    message = other.write(iter([rows_to_archive]))
    other.abort([message])
    assert everything(tmp_path) == (["shard_00000.tar.zst"], {"00000": ["a", "b"]}, {})


def test_a_broken_shard_is_tried_again(spark, corpus, tmp_path):
    """A folder in the place of an archive: that shard stays pending, the others are written."""
    rows = tables.write_index(assigned(spark, corpus), str(tmp_path / "index"))
    places = {"root": corpus, "archives": str(tmp_path / "a"), "manifest": str(tmp_path / "m"), "failures": str(tmp_path / "f")}
    os.remove(f"{corpus}/repo_a/file_2.py")
    whole = shards.write_shards(rows, **places).count()
    assert whole == 9 and [r.error for r in shards.read_failures(spark, places["failures"]).collect()] == [shards.GONE]
    assert not [n for n in os.listdir(tmp_path / "a") + os.listdir(tmp_path / "m") if n.endswith(".tmp")]


def test_stale_temporaries_are_swept(spark, corpus, tmp_path):
    archives = tmp_path / "a"
    archives.mkdir()
    (archives / ".shard_00001.99.tmp").write_bytes(b"left by a lost task")
    shards.write_shards(assigned(spark, corpus), root=corpus, archives=str(archives), manifest=str(tmp_path / "m"))
    assert not [n for n in os.listdir(archives) if n.endswith(".tmp")]


def test_a_second_build_writes_what_is_missing(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    sizes = {"rows_per_chunk": 4, "target": 1000, "min_size": 500, "max_size": 2000}
    first = build_dataset(spark, corpus, out, **sizes)
    rows = sorted(map(tuple, first.final.collect()))
    before = {n: os.stat(f"{out}/shards/{n}").st_mtime_ns for n in os.listdir(f"{out}/shards")}
    again = build_dataset(spark, corpus, out, **sizes)
    assert sorted(map(tuple, again.final.collect())) == rows and again.pending.count() == 0
    assert {n: os.stat(f"{out}/shards/{n}").st_mtime_ns for n in os.listdir(f"{out}/shards")} == before
    os.remove(f"{out}/shards/shard_00001.tar.zst")
    third = build_dataset(spark, corpus, out, **sizes)
    now = {n: os.stat(f"{out}/shards/{n}").st_mtime_ns for n in os.listdir(f"{out}/shards")}
    assert sorted(map(tuple, third.final.collect())) == rows
    assert {n for n in now if n.endswith(".zst") and now[n] != before.get(n)} == {"shard_00001.tar.zst"}


def test_a_dropped_shard_shows(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    sizes = {"target": 1000, "min_size": 500, "max_size": 2000}
    index = build_dataset(spark, corpus, out, **sizes).index
    os.remove(f"{corpus}/repo_a/file_2.py")
    os.remove(f"{out}/shards/shard_00000.tar.zst")
    built = build_dataset(spark, corpus, out, **sizes)
    check = built.archived.first()
    assert not check.files_match and check.files_diff == -1 and index.count() == 10
    assert [(r.file_path, r.error) for r in built.failures.collect()] == [("file_2.py", shards.GONE)]


def test_reconciling_with_documents(spark, corpus, tmp_path):
    def build(name, expected, **more):
        return build_dataset(spark, corpus, str(tmp_path / name), expected=expected, **more)

    tokens = build("plain", None).totals.first().total_tokens
    assert build("plain", None).reconciled.count() == 0
    document = tmp_path / "d.json"
    # the head says one thing, the map another: the head counts
    repos = {"repo/a": {"tokens": tokens, "files_processed": 10}}
    document.write_text(json.dumps({"total_tokens": tokens + 5, "total_repos": 1, "total_files": 9, "repos": repos}))
    check = build("one", str(document)).reconciled.first()
    assert (check.expected_tokens, check.expected_files, check.tokens_match) == (tokens + 5, 9, False)
    document.write_text("{broken")
    for path in (str(document), str(tmp_path / "absent.json")):
        built = build("two", path, update_counts=True)
        assert built.reconciled.count() == 0 and not built.summary_updated
        assert not os.path.exists(tmp_path / "two" / "token_counts")


def test_odd_names_links_and_closed_folders(spark, tmp_path):
    root = str(tmp_path / "r")
    put(root, "a_b/x.py", b"one")
    put(str(tmp_path / "elsewhere"), "linked/deep/y.py", b"two")
    os.symlink(tmp_path / "elsewhere" / "linked", f"{root}/l_ink")
    os.symlink(tmp_path / "elsewhere", f"{root}/a_b/not_entered")
    with open(os.fsencode(f"{root}/a_b/") + b"odd\xff\xe9.py", "wb") as handle:
        handle.write(b"three")
    put(root, "a_b/\ufffdFF.py", b"four")
    listing = tree.scan_tree(spark, root)
    found = {(r.dir_name, r.file_path): bytes(r.content) for r in tree.read_content(listing, root).collect()}
    assert found == {
        ("a_b", "x.py"): b"one",
        ("l_ink", "deep/y.py"): b"two",
        ("a_b", "odd\ufffdFF\ufffdE9.py"): b"three",
        ("a_b", "\ufffdEF\ufffdBF\ufffdBDFF.py"): b"four",
    }
    left = []
    assert list(tree.list_directory(f"{root}/gone", left_out=left)) == [] and left == [f"{root}/gone"]


def test_a_task_has_one_budget(spark, tmp_path):
    root = str(tmp_path / "r")
    for i in range(30):
        put(root, f"p_{i}/d/e/f.py", b"x")
    walk = tree._walk(root, 5, None)
    starts = pa.RecordBatch.from_pydict({"dir_name": [f"p_{i}" for i in range(30)], "file_path": [""] * 30})
    kinds = [r["kind"] for b in walk(iter([starts])) for r in b.to_pylist()]
    assert kinds.count("dir") >= 28
    assert tree.scan_tree(spark, root, budget=5).count() == 30


def test_rows_of_a_shard_without_archive_do_not_count(spark, corpus, tmp_path):
    archives, manifest = str(tmp_path / "a"), str(tmp_path / "m")
    rows = assigned(spark, corpus)
    whole = shards.write_shards(rows, root=corpus, archives=archives, manifest=manifest).count()
    os.remove(f"{archives}/shard_00000.tar.zst")
    left = shards.read_manifest(spark, manifest, archives)
    assert 0 < left.count() < whole and left.filter("shard_id = '00000'").count() == 0
    assert shards.write_shards(rows, root=corpus, archives=archives, manifest=manifest).count() == whole


def test_nothing_to_build(spark, tmp_path):
    root = str(tmp_path / "none")
    os.makedirs(root)
    built = build_dataset(spark, root, str(tmp_path / "out"))
    assert built.final.count() == 0 and built.totals.first().total_files == 0
