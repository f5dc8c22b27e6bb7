"""``code_tree``: a file tree as a data source.

``load_tree`` first walks the directories as a Spark job and stages what it met, one row per directory
with the number of its files and their bytes, dealt out to parts of about equal work. A partition of the
source is one such part, so a huge project, and even one huge directory, is read by many tasks, and the
driver plans from the names of the parts alone. A task lists its directories, leaves out those that no
file can pass in, applies the pushed predicates to path, name and size of each file, and opens a file
only if it passes and ``content`` is asked for.

Columns: ``dir_name, file_path, name, size, content``; reading with a schema that lacks some of them
leaves these out. Files that are gone or closed to us are left out, any other error fails the task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition

from corpusmill import staging, storage
from corpusmill.operators.ordering import running_sums
from corpusmill.sources import predicates, tree
from corpusmill.storage import Clients

SCHEMA = T.StructType([*tree.LISTING.fields, T.StructField("content", T.BinaryType())])
KNOWN = {"dir_name", "file_path", "name", "size"}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: A part's work is measured in bytes; a file or directory counts as so many bytes besides its own.
ENTRY_COST = 16 * 1024
LISTED_ROWS = 10_000


@dataclass
class Part(InputPartition):
    """A file of the staged walk."""

    path: str


class TreeReader(DataSourceReader):
    def __init__(self, root: str, walk: str, schema: T.StructType) -> None:
        self.root, self.walk, self.names = root, walk, schema.fieldNames()
        unknown = set(self.names) - set(SCHEMA.fieldNames())
        if unknown:
            raise ValueError(f"code_tree has no columns {sorted(unknown)}")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if predicates.decidable(f, KNOWN, {"size"}):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, inner = Clients().at(self.walk)
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
        return [Part(i.path) for i in found if i.base_name.endswith(".parquet")] or [Part("")]

    def entries(self, part: Part, clients: Clients) -> Iterator[dict[str, object]]:
        """Files of a part that meet the predicates, without their content."""
        import pyarrow.parquet as pq

        if not part.path:
            return
        system, _ = clients.at(self.walk)
        for row in pq.read_table(part.path, filesystem=system, columns=["dir_name", "folder", "slice", "slices"]).to_pylist():
            project, folder = row["dir_name"], row["folder"]
            prefix = f"{folder}/" if folder else ""
            whole = [("dir_name", project), *([("file_path", prefix)] if prefix else [])]
            if not all(predicates.may_hold(f, column, value) for f in self.filters for column, value in whole):
                continue
            place = tree.on_disk("/".join(p for p in (self.root, project, folder) if p))
            for name, is_dir, size in tree.list_directory(place, clients):
                if is_dir or row["slices"] > 1 and zlib.crc32(name.encode()) % row["slices"] != row["slice"]:
                    continue
                file = {"dir_name": project, "file_path": prefix + name, "name": name, "size": size}
                if predicates.meets(self.filters, file):
                    yield file

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(T.StructType([f for n in self.names for f in SCHEMA.fields if f.name == n]))
        clients, rows, held = Clients(), [], 0
        for file in self.entries(partition, clients):
            if "content" in self.names:
                content = tree.read_bytes(f"{self.root}/{file['dir_name']}/{file['file_path']}", clients)
                if content is None:
                    continue
                file["content"] = content
                held += len(content)
            rows.append(file)
            if held >= tree.READ_BATCH_BYTES or len(rows) >= LISTED_ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class CodeTree(DataSource):
    """Options: ``path``, the root with a project in each directory, and ``walk``, the staged walk."""

    @classmethod
    def name(cls) -> str:
        return "code_tree"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> TreeReader:
        for option in ("path", "walk"):
            if option not in self.options:
                raise ValueError(f"code_tree needs the option {option!r}; load_tree sets it")
        return TreeReader(self.options["path"], self.options["walk"], schema)


def walk_folders(spark: SparkSession, root: str, *, skip: str | None = None, part_bytes: int = tree.BYTES_PER_READ_TASK) -> str:
    """Walk all directories and stage them in parts of about ``part_bytes`` of work; returns the folder.

    ``part_bytes`` bounds a part but for a single file; a directory beyond it is dealt to several parts,
    each of which takes its share of the names.
    """
    folders = tree.walk_tree(spark, root, skip=skip, per_folder=True).filter("kind = 'folder'")
    cost = F.col("size") + (F.col("files") + 1) * ENTRY_COST
    slices = F.ceil(cost / part_bytes)
    dealt = folders.select(
        "dir_name", F.col("file_path").alias("folder"), slices.alias("slices"), F.ceil(cost / slices).alias("cost")
    ).withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    summed = running_sums(staging.stage(dealt, "tree-folders"), ["dir_name", "folder", "slice"], {"upto": "cost"})
    parts = summed.withColumn("part", F.expr(f"(upto - cost) div {part_bytes}"))
    path = staging.new_path(spark, "tree-parts")
    parts.repartition("part").write.partitionBy("part").parquet(path)
    return path


def load_tree(
    spark: SparkSession,
    root: str,
    columns: list[str] | None = None,
    *,
    skip: str | None = None,
    walk: str | None = None,
    part_bytes: int = tree.BYTES_PER_READ_TASK,
) -> DataFrame:
    """All regular files below every project directory of ``root``, hidden projects excluded.

    ``columns`` are those to read, all but ``content`` if none are named. Filters on path, name and size
    reach the source if the session's setting for that (``PUSHDOWN``) is on. ``walk``: an earlier result
    of ``walk_folders``; files that have come since into directories it met are read too.
    """
    root = storage.qualified(spark, root)
    walk = walk or walk_folders(spark, root, skip=skip, part_bytes=part_bytes)
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(CodeTree)
    chosen = T.StructType([f for n in columns or tree.LISTING.fieldNames() for f in SCHEMA.fields if f.name == n])
    loaded = spark.read.format("code_tree").schema(chosen).option("walk", storage.qualified(spark, walk)).load(root)
    # Spark keeps what was pushed last with a loaded source; a predicate that all meet takes its place
    return loaded.filter(F.col(chosen.fieldNames()[0]).isNotNull())
