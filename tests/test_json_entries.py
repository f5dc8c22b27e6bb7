import json
import random

import pytest

from corpusmill.sources import json_entries, state

NAMES = ["a/b", "q\"uote", "back\\slash", "br{ace}", "com,ma: [x]", "日本/é", "\\\\\"", "tab\t\n", "repos", "z"]


def document(rng, n, **style):
    repos = {f"{rng.choice(NAMES)}{i}": {"tokens": rng.randrange(10**6), "files_processed": i, "note": rng.choice(NAMES)} for i in range(n)}
    return {"total_tokens": 5, "head": {"x": [1, {"y": "}{"}]}, "repos": repos, "total_repos": n, "total_files": 7, "tail": "\\"}


class Bytes:
    """A file in memory."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, count, at):
        return self.data[at : at + count]


def by_splits(data, size, deepest=2):
    """Members found split by split, without Spark."""
    out, within, depth, parent = [], False, 0, None
    for start in range(0, max(1, len(data)), size):
        window = json_entries.Window(Bytes(data), start, start + size)
        plain, quoted = json_entries.effect(window.data, window.slashes())
        for m in json_entries.members(window, within, depth, deepest):
            parent = m.name if m.depth == 1 else parent
            out.append((m.depth, None if m.depth == 1 else parent, m.name, m.value, m.sound))
        ends, step = quoted if within else plain
        within, depth = ends, depth + step
    return out, within, depth


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": "\t"}])
def test_any_split_gives_the_same_members(style):
    made = document(random.Random(1), 12)
    data = json.dumps(made, **style).encode()
    wanted = []
    for name, value in made.items():
        container = isinstance(value, dict)
        wanted.append((1, None, name, None if container else value))
        wanted += [(2, name, k, v) for k, v in value.items()] if container else []
    for size in [*range(1, 60), 100, 997, len(data), 10 * len(data)]:
        found, within, depth = by_splits(data, size)
        assert (within, depth) == (False, 0), size
        assert [(d, p, n, None if v is None else json.loads(v)) for d, p, n, v, _ in found] == wanted, size
        assert all(m[4] for m in found)


def plain(path):
    made = json.loads(path.read_text())
    return {(n, t.get("tokens", 0), t.get("files_processed", 0)) for n, t in made["repos"].items()}


@pytest.mark.parametrize("split", [7, 100, 1 << 20])
def test_summary_in_splits(spark, tmp_path, split):
    path = tmp_path / "counts.json"
    path.write_text(json.dumps(document(random.Random(split), 15)))
    heads, repos = state.read_summary(spark, str(path), split_bytes=split)
    assert [tuple(r) for r in heads.collect()] == [(5, 15, 7)]
    assert {tuple(r) for r in repos.collect()} == plain(path) and repos.count() == 15


def test_many_documents_and_broken_ones(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    made = [document(random.Random(i), 5) for i in range(3)]
    for i, one in enumerate(made):
        (folder / f"{i}.json").write_text(json.dumps(one, indent=1))
    cut = json.dumps(document(random.Random(9), 5))
    (folder / "cut.json").write_text(cut[: len(cut) // 2])
    (folder / "odd.json").write_text('{"total_tokens": 1, "total_files": 1, "repos": {"x": {"tokens": 1} "y": {"tokens": 2}}}')
    (folder / "none.json").write_text("")
    heads, repos = state.read_summary(spark, str(folder), split_bytes=64)
    assert heads.count() == 3 and repos.count() == 15
    assert sorted(r.tokens for r in repos.collect()) == sorted(t["tokens"] for one in made for t in one["repos"].values())


def test_the_last_of_a_name_counts(spark, tmp_path):
    path = tmp_path / "twice.json"
    path.write_text('{"total_tokens":1,"total_files":2,"total_tokens":3,"repos":{"a":{"tokens":1},"b":null,"a":{"tokens":7}}}')
    heads, repos = state.read_summary(spark, str(path), split_bytes=16)
    assert [tuple(r) for r in heads.collect()] == [(3, None, 2)]
    assert sorted(tuple(r) for r in repos.collect()) == [("a", 7, 0), ("b", 0, 0)]


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    folder, written, real = tmp_path / "many", {}, json_entries.staging.stage
    folder.mkdir()
    for i in range(8):
        (folder / f"{i}.json").write_text(json.dumps(document(random.Random(i), 9)))

    def stage(df, label, *by):
        out = real(df, label, *by)
        written[label] = len(out.inputFiles())  # one of each task that had rows
        return out

    monkeypatch.setattr(json_entries.staging, "stage", stage)
    found = json_entries.read_members(spark, str(folder), split_bytes=32)
    assert written["json-members"] <= spark.sparkContext.defaultParallelism
    assert found.filter("depth = 2 AND parent = 'repos'").count() == 72 and found.filter("NOT sound").isEmpty()
