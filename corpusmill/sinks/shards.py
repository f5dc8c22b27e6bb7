"""Shard archives (tar in zstd) with a manifest of what they hold.

One task writes a shard as a stream, so it needs memory for one file and the compressor only.
Content is read by path when its turn comes; only index rows are shuffled. Archives and manifests
are written by a data source in two phases and appear under their final names when the whole write
is committed; headers are fixed, so a repeated task writes the same bytes again.
"""

from __future__ import annotations

import io
import tarfile
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill import staging, storage
from corpusmill.constants import ZSTD_LEVEL
from corpusmill.functions import paths
from corpusmill.operators.extract import conform
from corpusmill.operators.ordering import running_sums
from corpusmill.schemas import INDEX
from corpusmill.sources.state import path_exists
from corpusmill.sources.tree import BYTES_PER_READ_TASK, list_names, read_bytes
from corpusmill.storage import Clients

#: How many writes try a shard whose archive cannot be written, before it stays pending.
ATTEMPTS_CONF = "spark.corpusmill.attempts"
ATTEMPTS = "3"
#: How often a task tries to read a file, and seconds in between.
READ_TRIES = 3
READ_PAUSE = 1.0
ERROR = "_error"
GONE = "gone"
#: The error of a row whose whole shard could not be written starts so.
SHARD = "shard: "


class _Shard:
    """One archive and its manifest being written, both under hidden names."""

    def __init__(self, clients: Clients, job: TarZstWriter, shard_id: str):
        import zstandard

        self.shard_id, token = shard_id, uuid.uuid4().hex
        self.filesystem, folder = clients.at(job.archives)
        self.listing, listed = clients.at(job.manifest)
        self.archive, self.rows = f"{folder}/.{job.run}.{token}.tmp", f"{listed}/.{job.run}.{token}.tmp"
        self.raw = self.manifest = None
        try:
            for system, place in ((self.filesystem, folder), (self.listing, listed)):
                system.create_dir(place, recursive=True)
            self.raw = self.filesystem.open_output_stream(self.archive)
            self.packed = zstandard.ZstdCompressor(level=job.level).stream_writer(self.raw, closefd=False)
            self.tar = tarfile.open(fileobj=self.packed, mode="w|")
            self.manifest = pq.ParquetWriter(self.rows, job.listed(), filesystem=self.listing)
        except BaseException:
            self.discard()
            raise

    def add(self, name: str, content: bytes) -> None:
        header = tarfile.TarInfo(name)
        header.size = len(content)
        self.tar.addfile(header, io.BytesIO(content))

    def note(self, rows: pa.RecordBatch) -> None:
        if rows.num_rows:
            self.manifest.write_batch(rows.select(self.manifest.schema.names))

    def noted(self) -> Iterator[pa.RecordBatch]:
        """The rows noted so far; no more can follow."""
        if self.manifest is not None:
            self.manifest.close()
            for rows in pq.ParquetFile(self.rows, filesystem=self.listing).iter_batches():
                ids = pa.array([self.shard_id] * rows.num_rows, pa.string())
                yield rows.append_column("shard_id", ids)

    def finish(self) -> Finished:
        self.tar.close()
        self.packed.close()
        self.raw.close()
        self.manifest.close()
        return Finished(self.shard_id, self.archive, self.rows)

    def discard(self) -> None:
        """Remove what was written, whatever state it is in."""
        steps = [c.close for c in (self.raw, self.manifest) if c is not None]
        steps += [lambda: self.filesystem.delete_file(self.archive), lambda: self.listing.delete_file(self.rows)]
        for step in steps:
            try:
                step()
            except (OSError, pa.ArrowException):
                pass


class Finished(NamedTuple):
    """A shard written under hidden names."""

    shard_id: str
    archive: str
    rows: str


@dataclass
class Shards(WriterCommitMessage):
    """What a task has written: shards, and the hidden file of rows it left out, if any."""

    finished: list[Finished]
    failures: str | None


class TarZstWriter(DataSourceArrowWriter):
    """Writes shards in two phases: tasks under hidden names of this run, the commit gives them their own.

    Tasks take index rows with ``_member`` and ``_location``, sorted by shard, and read the files as
    their turn comes. A file that is gone, or that cannot be read in ``READ_TRIES``, is left out of its
    shard, and a shard whose archive cannot be written is left out as a whole; both are noted with their
    errors in a file of failures. Nothing of a task that fails or is lost is committed, and the commit
    removes what such tasks have left. A shard counts once its archive is there (``read_manifest``), which
    the commit puts last, so that one that is interrupted leaves the shard pending.
    """

    def __init__(self, archives: str, manifest: str, failures: str, level: int, columns: pa.Schema):
        self.archives, self.manifest, self.failures, self.level = archives, manifest, failures, level
        self.columns, self.run = columns, uuid.uuid4().hex

    def _read(self, location: str, clients: Clients) -> tuple[bytes | None, str | None]:
        for left in range(READ_TRIES - 1, -1, -1):
            try:
                content = read_bytes(location, clients)
                return content, None if content is not None else GONE
            except Exception as reason:
                error = f"{type(reason).__name__}: {reason}"
                if left:
                    time.sleep(READ_PAUSE)
        return None, error

    def _fill(self, shard: _Shard, piece: pa.RecordBatch, clients: Clients) -> list[str | None]:
        """Add the files of ``piece`` to the shard and its manifest; the error of each that is left out."""
        errors = []
        for row in piece.select(["_member", "_location"]).to_pylist():
            content, error = self._read(row["_location"], clients)
            if error is None:
                shard.add(row["_member"], content)
            errors.append(error)
        shard.note(self._named(piece).filter(pa.array([e is None for e in errors], pa.bool_())))
        return errors

    def listed(self) -> pa.Schema:
        """Columns of a manifest; its folder names the shard."""
        return pa.schema([f for f in self.columns if f.name != "shard_id"])

    def _named(self, piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.select(self.columns.names).cast(self.columns)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shards:
        clients = Clients()
        finished: list[Finished] = []
        shard, broken, current, notes = None, None, None, None
        try:
            for shard_id, piece in by_shard(batches):
                if shard_id != current:
                    if shard is not None:
                        finished.append(shard.finish())
                    shard, broken, current = None, None, shard_id
                errors: list[str | None]
                try:
                    if broken is None:
                        shard = shard or _Shard(clients, self, shard_id)
                        errors = self._fill(shard, piece, clients)
                except Exception as reason:
                    broken = f"{SHARD}{type(reason).__name__}: {reason}"
                    if shard is not None:
                        for rows in shard.noted():
                            notes = self._noted(notes, clients, self._named(rows), [broken] * rows.num_rows)
                        shard.discard()
                        shard = None
                if broken is not None:
                    errors = [broken] * piece.num_rows
                notes = self._noted(notes, clients, self._named(piece), errors)
            if shard is not None:
                finished.append(shard.finish())
                shard = None
            if notes is not None:
                notes[0].close()
            return Shards(finished, notes[1] if notes is not None else None)
        except BaseException:
            if shard is not None:
                shard.discard()
            self._remove(clients, finished, notes[1] if notes is not None else None)
            raise

    def _noted(self, notes, clients: Clients, piece: pa.RecordBatch, errors: list[str | None]):
        """The open file of failures, with the rows of ``piece`` that have an error."""
        kept = [e is not None for e in errors]
        if not any(kept):
            return notes
        if notes is None:
            system, folder = clients.at(self.failures)
            system.create_dir(folder, recursive=True)
            path = f"{folder}/.{self.run}.{uuid.uuid4().hex}.tmp"
            notes = pq.ParquetWriter(path, self.columns.append(pa.field(ERROR, pa.string())), filesystem=system), path
        rows = pa.RecordBatch.from_arrays([*piece.columns, pa.array(errors, pa.string())], names=[*self.columns.names, ERROR])
        notes[0].write_batch(rows.filter(pa.array(kept, pa.bool_())))
        return notes

    def _remove(self, clients: Clients, finished: list[Finished], failures: str | None) -> None:
        for folder, path in [
            *((self.archives, f.archive) for f in finished),
            *((self.manifest, f.rows) for f in finished),
            *([(self.failures, failures)] if failures else []),
        ]:
            try:
                clients.at(folder)[0].delete_file(path)
            except OSError:
                pass

    def _sweep(self, clients: Clients) -> None:
        """Remove what lost tasks of this run have left."""
        from pyarrow import fs

        for folder in {self.archives, self.manifest, self.failures}:
            system, inner = clients.at(folder)
            for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                if info.base_name.startswith(f".{self.run}."):
                    system.delete_file(info.path)

    def commit(self, messages: list[Shards | None]) -> None:
        clients = Clients()
        (archives, folder), (manifest, listed) = clients.at(self.archives), clients.at(self.manifest)
        for number, message in enumerate(messages):
            if message is None:
                continue
            for shard in message.finished:
                own = f"{listed}/shard_id={shard.shard_id}"
                manifest.create_dir(own, recursive=True)
                manifest.delete_dir_contents(own)
                manifest.move(shard.rows, f"{own}/part-0.parquet")
                archives.move(shard.archive, f"{folder}/shard_{shard.shard_id}.tar.zst")
            if message.failures:
                system, notes = clients.at(self.failures)
                system.move(message.failures, f"{notes}/part-{self.run}-{number}.parquet")
        self._sweep(clients)

    def abort(self, messages: list[Shards | None]) -> None:
        self._sweep(Clients())


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Stretches of rows of one shard."""
    for batch in batches:
        ids = batch.column(batch.schema.names.index("shard_id")).to_pylist()
        start = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[start]:
                yield ids[start], batch.slice(start, i - start)
                start = i


class TarZst(DataSource):
    """Sink ``tar_zst``. Options: ``path`` of the archives, ``manifest``, ``failures``, ``level``."""

    @classmethod
    def name(cls) -> str:
        return "tar_zst"

    def schema(self) -> StructType:
        return StructType([*INDEX.fields, *(StructField(c, StringType()) for c in ("_member", "_location"))])

    def writer(self, schema: StructType, overwrite: bool) -> TarZstWriter:
        if overwrite:
            raise ValueError("tar_zst only adds shards; use mode append")
        missing = set(self.schema().fieldNames()) - set(schema.fieldNames())
        if missing:
            raise ValueError(f"tar_zst needs the columns {sorted(missing)}")
        wanted = (self.options[o] for o in ("path", "manifest", "failures"))
        return TarZstWriter(*wanted, int(self.options.get("level", ZSTD_LEVEL)), to_arrow_schema(INDEX))


def sweep(spark: SparkSession, folder: str) -> None:
    """Remove the temporary files that lost tasks have left in a folder of archives. No other run
    may be writing there."""
    names = list_names(spark, folder, False).filter(F.col("name").rlike(r"^\..*\.tmp$"))
    folder = storage.qualified(spark, folder)

    def run(batches):
        clients = Clients()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                filesystem, inner = clients.at(f"{folder}/{name}")
                filesystem.delete_file(inner)
            yield batch

    names.mapInArrow(run, "name string").count()


def archived_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the shards whose archive is complete."""
    shard_id = F.regexp_extract("name", r"^shard_(\d+)\.tar\.zst$", 1)
    return list_names(spark, folder, False).select(shard_id.alias("shard_id")).filter("shard_id <> ''")


def pending_shards(assigned: DataFrame, manifest: DataFrame, archived: DataFrame) -> DataFrame:
    """Rows of shards that lack their archive or their manifest."""
    done = manifest.select("shard_id").distinct().join(archived, "shard_id", "left_semi")
    return assigned.join(done, "shard_id", "left_anti").select(*assigned.columns)


def read_manifest(spark: SparkSession, path: str, archives: str) -> DataFrame:
    """Manifest rows of the shards whose archive is complete."""
    rows = conform(spark.read.schema(INDEX).parquet(path))
    return rows.join(archived_shards(spark, archives), "shard_id", "left_semi").select(*INDEX.fieldNames())


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Files that the last run could not archive: index columns and ``error``."""
    schema = StructType([*INDEX.fields, StructField(ERROR, StringType())])
    rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return rows.withColumnRenamed(ERROR, "error")


def write_shards(
    assigned: DataFrame, *, root: str, archives: str, manifest: str, level: int = ZSTD_LEVEL, failures: str | None = None
) -> DataFrame:
    """Write the archives and manifests that are not there yet; returns the whole manifest.

    ``assigned`` is a staged index with ``shard_id``; files are read below ``root``. Files that are
    gone or cannot be read are left out of archive and manifest. A shard that cannot be written is
    tried again by another write, and left out as a whole after the last; it is pending again the next
    time. Both are written to ``failures``, if it names a folder. Rows are passed on as they are archived,
    so that a shard of very many small files needs no memory of its own.
    """
    spark = assigned.sparkSession
    archives, root, manifest = (storage.qualified(spark, p) for p in (archives, root, manifest))
    spark.dataSource.register(TarZst)
    sweep(spark, archives)
    rows, left_out = conform(assigned), []
    for _ in range(int(spark.conf.get(ATTEMPTS_CONF, ATTEMPTS))):
        if path_exists(spark, manifest):
            rows = pending_shards(rows, read_manifest(spark, manifest, archives), archived_shards(spark, archives))
            rows = staging.stage(rows, "pending")  # the manifest is written while it would be read
        noted = storage.qualified(spark, staging.new_path(spark, "left-out"))
        if not _write_pending(rows, root, archives, manifest, noted, level):
            break
        left_out.append(read_failures(spark, noted))
    if failures is not None and left_out:
        # of shards that another write has tried again, only what that write left out
        last = left_out[-1]
        archived = archived_shards(spark, archives)
        for earlier in left_out[:-1]:
            last = last.unionByName(earlier.join(archived, "shard_id", "left_semi").filter(~F.col("error").startswith(SHARD)))
        last.withColumnRenamed("error", ERROR).write.mode("overwrite").parquet(failures)
    return read_manifest(spark, manifest, archives) if path_exists(spark, manifest) else rows


def _write_pending(rows: DataFrame, root: str, archives: str, manifest: str, failures: str, level: int) -> bool:
    """Write the shards of ``rows``; whether there were any."""
    spark = rows.sparkSession
    # tasks by the bytes to archive: Spark itself would go by the size of the index rows. Shards are
    # dealt out by their rank among the pending ones, which need not have consecutive numbers.
    pending = rows.groupBy("shard_id").agg(F.sum("size").alias("size"))
    ranked = running_sums(pending, ["shard_id"], {"_rank": None, "_bytes": "size"})
    bounds = ranked.agg(F.max("_rank").alias("shards"), F.max("_bytes").alias("bytes")).first()
    if bounds["shards"] is None:
        return False
    wanted = max(-(-(bounds["bytes"] or 0) // BYTES_PER_READ_TASK), spark.sparkContext.defaultParallelism)
    tasks = min(bounds["shards"], wanted)
    dealt = rows.join(ranked.select("shard_id", "_rank"), "shard_id")
    spread = dealt.repartitionById(tasks, F.pmod(F.col("_rank"), F.lit(tasks)).cast("int"))
    ordered = spread.sortWithinPartitions("shard_id", "project_name", "file_path")
    project, file_path = F.col("project_name"), F.col("file_path")
    located = ordered.select(
        *INDEX.fieldNames(),
        paths.member_name(project, file_path).alias("_member"),
        paths.source_path(project, file_path, root).alias("_location"),
    )
    writer = located.write.format("tar_zst").mode("append").option("level", str(level))
    writer.option("manifest", manifest).option("failures", failures).save(archives)
    return True
