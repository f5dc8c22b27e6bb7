"""Complete listing of a file tree, and late reading of file bytes.

Spark's own file listing hides names that start with ``_`` or ``.`` and its binary reader drops
empty files, which would lose every ``__init__.py``. So tasks walk the directories themselves.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging, storage
from corpusmill.functions import paths
from corpusmill.schemas import LISTING
from corpusmill.storage import Clients, local_path

ENTRIES_PER_WALK = 20_000
FOLDERS_PER_TASK = 50
BYTES_PER_READ_TASK = 256 * 1024 * 1024
WALK_BATCH_ROWS = 10_000
READ_BATCH_BYTES = 16 * 1024 * 1024


_LEFT_OUT = (FileNotFoundError, NotADirectoryError, IsADirectoryError, PermissionError)


def list_directory(
    path: str, clients: Clients | None = None, follow: bool = False, left_out: list[str] | None = None
) -> Iterator[tuple[str, bool, int]]:
    """``(name, is_directory, size)`` of the entries of one directory, as they come.

    Linked directories count as directories only with ``follow``. A name that is not UTF-8 is given
    with its odd bytes escaped as Python does (see :func:`shown`). What is gone or closed to us is
    left out and named in ``left_out``; any other error fails the task, which is then tried again.
    """
    left_out = [] if left_out is None else left_out
    local = local_path(path)
    if local is not None:
        try:
            entries = os.scandir(local)
        except _LEFT_OUT:
            left_out.append(path)
            return
        with entries:
            for entry in entries:
                try:
                    if entry.is_dir(follow_symlinks=follow):
                        yield shown(entry.name), True, 0
                    elif entry.is_file():
                        yield shown(entry.name), False, entry.stat().st_size
                except _LEFT_OUT:
                    left_out.append(f"{path}/{shown(entry.name)}")
        return
    from pyarrow import fs

    filesystem, inner = (clients or Clients()).at(path)
    for info in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        yield info.base_name, info.type == fs.FileType.Directory, info.size or 0


_ODD = re.compile("[\udc80-\udcff]")
_MARKED = re.compile("\ufffd([0-9A-F]{2})")


def shown(name: str) -> str:
    """A file name as UTF-8 text: each byte that is not UTF-8 becomes U+FFFD and its two digits, and
    so does each byte of U+FFFD itself."""
    plain = name.replace("\ufffd", "\udcef\udcbf\udcbd")
    return _ODD.sub(lambda m: f"\ufffd{ord(m[0]) - 0xDC00:02X}", plain)


def on_disk(name: str) -> str:
    """The name that :func:`shown` was given."""
    return _MARKED.sub(lambda m: chr(0xDC00 + int(m[1], 16)), name)


def read_bytes(path: str, clients: Clients | None = None) -> bytes | None:
    """Whole content of a file, or None if it is gone or closed to us."""
    local = local_path(path)
    try:
        if local is not None:
            with open(on_disk(local), "rb") as handle:
                return handle.read()
        filesystem, inner = (clients or Clients()).at(path)
        with filesystem.open_input_stream(inner) as handle:
            return handle.read()
    except _LEFT_OUT:
        return None


def _walk(root: str, budget: int, skip: str | None, per_folder: bool = False):
    """Arrow function: walk directory rows until a task has met ``budget`` entries, hand back the rest."""

    def visit(starts: Iterator[dict]) -> Iterator[dict]:
        clients, seen = Clients(), 0
        for start in starts:
            dir_name, pending = start["dir_name"], [start["file_path"]]
            while pending and seen < budget:
                inner = pending.pop()
                if skip is not None and skip in f"{dir_name}/{inner}":
                    continue
                left_out: list[str] = []
                folder = on_disk("/".join(p for p in (root, dir_name, inner) if p))
                files = held = 0
                for name, is_dir, size in list_directory(folder, clients, left_out=left_out):
                    seen += 1
                    path = f"{inner}/{name}" if inner else name
                    if is_dir:
                        pending.append(path)
                    elif per_folder:
                        files, held = files + 1, held + size
                    else:
                        yield {"dir_name": dir_name, "file_path": path, "size": size, "kind": "file"}
                if files:
                    yield {"dir_name": dir_name, "file_path": inner, "size": held, "kind": "folder", "files": files}
                for path in left_out:
                    yield {"dir_name": dir_name, "file_path": shown(path), "size": 0, "kind": "left out"}
            for path in pending:
                yield {"dir_name": dir_name, "file_path": path, "size": 0, "kind": "dir"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = visit(start for batch in batches for start in batch.to_pylist())
        while held := list(islice(rows, WALK_BATCH_ROWS)):
            yield pa.RecordBatch.from_pylist(held, schema=_WALK_ARROW)

    return run


_WALK_SCHEMA = "dir_name string, file_path string, size long, kind string, files long"
_WALK_ARROW = pa.schema(
    [("dir_name", pa.string()), ("file_path", pa.string()), ("size", pa.int64()), ("kind", pa.string()), ("files", pa.int64())]
)


def list_names(spark: SparkSession, folder: str, directories: bool) -> DataFrame:
    """``name`` of the directories (links followed) or of the files right below ``folder``."""
    top = spark.createDataFrame([(storage.qualified(spark, folder),)], "folder string")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names = (n for n, is_dir, _ in list_directory(row["folder"], follow=True) if is_dir == directories)
                while held := list(islice(names, WALK_BATCH_ROWS)):
                    yield pa.RecordBatch.from_pydict({"name": pa.array(held, pa.string())})

    return top.mapInArrow(run, "name string")


def list_projects(spark: SparkSession, root: str) -> DataFrame:
    """Directories right below ``root`` that are not hidden: ``dir_name``, ``project_name``."""
    dirs = list_names(spark, root, True).select(F.col("name").alias("dir_name"))
    dirs = dirs.filter(~paths.is_hidden(F.col("dir_name")))
    return dirs.withColumn("project_name", paths.dir_to_project(F.col("dir_name")))


def walk_tree(
    spark: SparkSession,
    root: str,
    *,
    skip: str | None = None,
    budget: int = ENTRIES_PER_WALK,
    per_folder: bool = False,
) -> DataFrame:
    """``dir_name, file_path, size, kind, files``: every ``file`` below every project directory, and every
    path that was ``left out`` because it was gone or closed to us. ``per_folder``: instead of its files
    a ``folder`` for each directory that holds any, with their number and their bytes.

    The walk goes in rounds. A task walks directories up to ``budget`` entries and hands the
    directories it did not reach back to the next round, which has as many tasks as there are
    directories left to share out, so one huge project does not become one long task.
    """
    root = storage.qualified(spark, root)
    least = spark.sparkContext.defaultParallelism
    frontier = list_projects(spark, root).select("dir_name", F.lit("").alias("file_path"))
    rounds: list[DataFrame] = []
    tasks = least
    while True:
        spread = frontier.repartition(tasks, "dir_name", "file_path")
        found = staging.stage(spread.mapInArrow(_walk(root, budget, skip, per_folder), _WALK_SCHEMA), "tree-round")
        rounds.append(found.filter("kind <> 'dir'"))
        frontier = found.filter("kind = 'dir'").select("dir_name", "file_path")
        left = frontier.count()
        if not left:
            break
        tasks = max(least, left // FOLDERS_PER_TASK)
    files = rounds[0]
    for more in rounds[1:]:
        files = files.unionByName(more)
    return files


def scan_tree(
    spark: SparkSession, root: str, *, skip: str | None = None, budget: int = ENTRIES_PER_WALK
) -> DataFrame:
    """Every regular file below every project directory: path, name and size, no content.
    Directories whose path from the project on contains ``skip`` are not entered."""
    files = walk_tree(spark, root, skip=skip, budget=budget).filter("kind = 'file'")
    return files.select(
        "dir_name", "file_path", paths.basename(F.col("file_path")).alias("name"), "size"
    ).to(LISTING)


def read_content(listing: DataFrame, root: str) -> DataFrame:
    """Add ``content``; files that cannot be read are left out.

    Call it after the filters on name and size. The listing is spread by file, not by project,
    over as many tasks as its bytes need, so that big projects are read by many tasks; only
    paths are shuffled.
    """
    spark = listing.sparkSession
    root = storage.qualified(spark, root)
    listed = listing.agg(F.sum("size")).first()[0] or 0
    tasks = max(-(-listed // BYTES_PER_READ_TASK), spark.sparkContext.defaultParallelism)
    schema = listing.schema.add("content", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients = Clients()
        for batch in batches:
            rows: list[dict] = []
            held = 0
            for row in batch.to_pylist():
                content = read_bytes(f"{root}/{row['dir_name']}/{row['file_path']}", clients)
                if content is None:
                    continue
                rows.append({**row, "content": content})
                held += len(content)
                if held >= READ_BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return listing.repartition(tasks, "dir_name", "file_path").mapInArrow(run, schema)


def write_tree(files: DataFrame, root: str) -> DataFrame:
    """Write rows of ``dir_name, file_path, content`` as files; returns the written paths.

    For corpora that are held as a table. Lazy: the files appear when the result is used.
    """
    root = storage.qualified(files.sparkSession, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients = Clients()
        for batch in batches:
            for row in batch.to_pylist():
                filesystem, inner = clients.at(f"{root}/{row['dir_name']}/{row['file_path']}")
                filesystem.create_dir(os.path.dirname(inner), recursive=True)
                with filesystem.open_output_stream(inner) as handle:
                    handle.write(row["content"] or b"")
            yield batch.select(["dir_name", "file_path"])

    chosen = files.select("dir_name", "file_path", F.col("content").cast("binary").alias("content"))
    return chosen.mapInArrow(run, "dir_name string, file_path string")
