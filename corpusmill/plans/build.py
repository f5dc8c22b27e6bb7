"""The dataset build: file tree → metadata → index → shards → roll-up and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging, storage
from corpusmill.constants import CHUNK_ROWS, MAX_FILE_SIZE, SHARD_MAX, SHARD_MIN, SHARD_TARGET
from corpusmill.functions.tokens import Tokenizer
from corpusmill.functions import paths
from corpusmill.operators import extract, packing, repo_stats, rollup
from corpusmill.operators.repo_stats import token_counter, uncounted
from corpusmill.schemas import INDEX, REPO
from corpusmill.sinks import shards, tables
from corpusmill.sources import state, tree


@dataclass
class Built:
    """What a build has written.

    ``pending`` are files of shards that lack their archive, ``failures`` files and shards that could
    not be archived, with the error. ``reconciled`` compares the final table with the expected
    totals (no row without them), ``archived`` compares it with the index.
    """

    index: DataFrame
    pending: DataFrame
    failures: DataFrame
    final: DataFrame
    projects: DataFrame
    totals: DataFrame
    reconciled: DataFrame
    archived: DataFrame
    summary_updated: bool


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    return state.path_exists(spark, f"{path}/_SUCCESS")


def build_dataset(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    expected: str | None = None,
    update_counts: bool = False,
    tokenizer: Tokenizer = "regex",
    max_file_size: int = MAX_FILE_SIZE,
    rows_per_chunk: int = CHUNK_ROWS,
    target: int = SHARD_TARGET,
    min_size: int = SHARD_MIN,
    max_size: int = SHARD_MAX,
) -> Built:
    """Build the dataset of the projects below ``root`` into the folder ``out``.

    A second run on the same ``out`` goes on where the first one stopped: complete metadata, index
    and shards are taken as they are, and only what is missing is written. Start over in a new
    folder. Content is read twice: once for metadata and once for the archives; it is never
    shuffled. ``expected`` names a summary document to reconcile with.
    """
    root, out = storage.qualified(spark, root), storage.qualified(spark, out)
    chunks, indexed, sharded = f"{out}/metadata_chunks", f"{out}/global_index", f"{out}/sharded_index"
    archives, manifests, failed = f"{out}/shards", f"{out}/shard_metadata", f"{out}/shard_failures"
    with staging.scope(spark):
        if not _complete(spark, chunks):
            storage.delete(spark, chunks)
            listing = tree.scan_tree(spark, root, skip=".git")
            files = tree.read_content(extract.candidates(listing, max_size=max_file_size), root)
            metadata = extract.extract_metadata(files, root=root, max_size=max_file_size, tokenizer=tokenizer)
            tables.write_chunks(metadata, chunks, rows_per_file=rows_per_chunk)
        if not _complete(spark, indexed):
            storage.delete(spark, indexed)
            tables.write_index(extract.build_index(state.read_chunks(spark, chunks)), indexed)
        index = spark.read.schema(INDEX).parquet(indexed)
        if not _complete(spark, sharded):
            storage.delete(spark, sharded)
            packed = packing.assign_shards(index, target=target, min_size=min_size, max_size=max_size)
            tables.write_index(packed, sharded)
        assigned = spark.read.schema(INDEX).parquet(sharded)
        manifest = shards.write_shards(
            assigned, root=root, archives=archives, manifest=manifests, failures=failed
        )
        final = tables.write_final(manifest, f"{out}/final_metadata")

    pending = shards.pending_shards(assigned, manifest, shards.archived_shards(spark, archives))
    projects = rollup.project_rollup(final)
    totals = rollup.corpus_totals(final)
    wanted = state.read_summary(spark, expected)[0] if expected is not None else totals.limit(0)
    reconciled = rollup.reconcile(totals, wanted)
    archived = rollup.reconcile(totals, rollup.corpus_totals(index))
    updated = tables.update_summary(projects, reconciled, f"{out}/token_counts", update=update_counts)
    failures = shards.read_failures(spark, failed)
    return Built(index, pending, failures, final, projects, totals, reconciled, archived, updated)


def count_tree(
    spark: SparkSession, root: str, *, already: DataFrame | None = None, tokenizer: Tokenizer = "regex"
) -> DataFrame:
    """Lossy token counts of all projects below ``root`` that ``already`` does not name."""
    listing = tree.scan_tree(spark, root, skip=".git").filter(F.col("size") <= MAX_FILE_SIZE)
    projects = tree.list_projects(spark, root)
    if already is not None:
        listing, projects = uncounted(listing, already), uncounted(projects, already)
    return token_counter(tree.read_content(listing, root), projects, tokenizer=tokenizer)


def stats_tree(
    spark: SparkSession,
    root: str,
    *,
    purge: bool = True,
    caps: dict[str, int] | None = None,
    tokenizer: Tokenizer = "regex",
) -> DataFrame:
    """Statistics of every project below ``root``, empty ones included.

    Files and bytes come from the listing; only files that count towards tokens are read.
    """
    listing = staging.stage(repo_stats.with_dropped(tree.scan_tree(spark, root), purge, caps), "listing")
    wanted = repo_stats.countable(listing.filter(~F.col("_dropped")))
    counted = repo_stats.file_tokens(tree.read_content(wanted, root), tokenizer=tokenizer)
    return repo_stats.joined_stats(
        tree.list_projects(spark, root), repo_stats.listing_stats(listing), repo_stats.content_stats(counted)
    )


def record_tree(
    spark: SparkSession, root: str, db: DataFrame, *, at: Column, stored_tokens: Column | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Records of all repositories after a look at the tree, and their totals.

    Repositories in ``db`` get the statistics of their folder, folders that ``db`` does not name get
    a record of their own, and records without a folder stay. ``stored_tokens`` is the total that
    the state document holds.
    """
    stats = staging.stage(stats_tree(spark, root, **options), "tree-stats")
    named = stats.withColumn("full_name", paths.dir_to_project(F.col("dir_name")))
    new = F.struct(*(F.col(f"_new.{c}").alias(c) for c in REPO["stats"].dataType.fieldNames()))
    fresh = named.select("full_name", F.struct(*stats.columns).alias("_new"))
    known = db.join(fresh, "full_name", "inner").withColumn("stats", new).drop("_new").withColumn("cloned_at", at)
    records = repo_stats.upsert_repos(db.to(REPO), known.to(REPO))
    whole = staging.stage(repo_stats.backfill_repos(stats, records, root=root, at=at), "repos")
    return whole, repo_stats.recalc_totals(whole, F.lit(None).cast("long") if stored_tokens is None else stored_tokens)
