"""From a file listing with content to per-file metadata and the global index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.constants import MAX_CONTENT_CHARS, MAX_FILE_SIZE
from corpusmill.functions import paths, text
from corpusmill.functions.tokens import Tokenizer, count_tokens
from corpusmill.schemas import FILE_CHUNK, INDEX


def is_candidate(max_size: int = MAX_FILE_SIZE) -> Column:
    """Rules that need only the listing, so they run before any content is read."""
    directory, path, size = F.col("dir_name"), F.col("file_path"), F.col("size")
    return (
        ~paths.is_hidden(directory)
        & ~paths.under_git_like(directory, path)
        & F.endswith(path, F.lit(".py"))
        & (size <= F.lit(max_size))
    )


def candidates(listing: DataFrame, *, max_size: int = MAX_FILE_SIZE) -> DataFrame:
    return listing.filter(is_candidate(max_size))


#: Rules in the order they are applied, and what passes all of them.
REASONS = ("hidden", "git", "suffix", "size", "binary", "encoding", "kept")


def drop_reason(max_size: int = MAX_FILE_SIZE) -> Column:
    """The first rule that rejects a file with its content, or ``kept``."""
    directory, path, content = F.col("dir_name"), F.col("file_path"), F.col("content")
    failed = [
        paths.is_hidden(directory),
        paths.under_git_like(directory, path),
        ~F.endswith(path, F.lit(".py")),
        F.col("size") > F.lit(max_size),
        text.has_nul(content),
        ~text.is_utf8(content),
    ]
    chain = F.when(failed[0], REASONS[0])
    for rule, name in zip(failed[1:], REASONS[1:]):
        chain = chain.when(rule, name)
    return chain.otherwise(REASONS[-1])


def drop_counts(spark: SparkSession, audit: Observation) -> DataFrame:
    """``reason, files`` of an audit whose extraction has been used."""
    return spark.createDataFrame(list(audit.get.items()), "reason string, files long")


def extract_metadata(
    files: DataFrame,
    *,
    root: str = "",
    max_size: int = MAX_FILE_SIZE,
    tokenizer: Tokenizer = "regex",
    audit: Observation | None = None,
) -> DataFrame:
    """Metadata of every file that passes all rules; the others are left out silently.

    ``files`` holds ``dir_name, file_path, size, content``. An empty file passes, with 0 tokens. ``audit``
    receives, once the result is used, how many files each rule was the first to reject, and how many
    passed (:data:`REASONS`), counted in the same pass; use the result as the last step of one write, as
    a stage that Spark repeats for a shuffle would count again.
    """
    content = F.col("content")
    project = paths.dir_to_project(F.col("dir_name"))
    if audit is not None:
        reason = drop_reason(max_size)
        files = files.observe(audit, *[F.count_if(reason == r).alias(r) for r in REASONS])
    return (
        candidates(files, max_size=max_size)
        .filter(text.is_strict_text(content))
        .select(
            project.alias("project_name"),
            F.col("file_path").alias("relative_path"),
            F.col("size").alias("file_size"),
            text.sha256_hex(content).alias("sha256"),
            count_tokens(content.cast("string"), tokenizer).alias("token_count"),
            F.concat(F.lit(root.rstrip("/") + "/"), F.col("dir_name"), F.lit("/"), F.col("file_path")).alias(
                "absolute_path"
            ),
        )
        .to(FILE_CHUNK)
    )


def build_index(chunks: DataFrame) -> DataFrame:
    """Chunk rows in the shape of the global index; no shard is assigned yet."""
    return chunks.select(
        "project_name",
        F.col("relative_path").alias("file_path"),
        F.col("token_count").cast("long").alias("tokens"),
        F.col("file_size").cast("long").alias("size"),
        "sha256",
        F.lit(None).cast("string").alias("shard_id"),
    )


def conform(df: DataFrame, schema: T.StructType = INDEX) -> DataFrame:
    """Check a table against ``schema``: same columns by name, cast where a type differs."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def flat_names(files: DataFrame) -> DataFrame:
    """One flat directory per project: the first file of a name keeps it, the others get a
    suffix from the hash of their path, which is the same on every run.

    Wants ``project_name, file_path``. The first files come from a pre-aggregated minimum and are
    found again by their whole path, so no join key is shared by the many files of one name.
    """
    path, name = F.col("file_path"), paths.basename(F.col("file_path"))
    first = files.groupBy("project_name", name.alias("_name")).agg(F.min("file_path").alias("file_path"))
    marked = files.join(
        first.select("project_name", "file_path", F.lit(True).alias("_first")),
        ["project_name", "file_path"],
        "left",
    )
    mark = F.substring(F.sha2(path.cast("binary"), 256), 1, 16)
    renamed = F.concat(paths.stem(name), F.lit("_"), mark, paths.raw_suffix(name))
    return marked.select(*files.columns, F.when(F.col("_first"), name).otherwise(renamed).alias("flat_name"))


def existing_files(index: DataFrame, listing: DataFrame) -> DataFrame:
    """Index rows whose file is still there."""
    return index.join(_present(listing), ["project_name", "file_path"], "left_semi")


def missing_files(index: DataFrame, listing: DataFrame) -> DataFrame:
    """Index rows whose file is gone."""
    return index.join(_present(listing), ["project_name", "file_path"], "left_anti")


def _present(listing: DataFrame) -> DataFrame:
    return listing.select(paths.dir_to_project(F.col("dir_name")).alias("project_name"), "file_path")


def lossy_content(files: DataFrame, *, max_chars: int = MAX_CONTENT_CHARS) -> DataFrame:
    """Add ``text``: the lossy reading of ``content``, cut at ``max_chars``."""
    return files.withColumn("text", text.truncate(text.lossy_text(F.col("content")), max_chars))
