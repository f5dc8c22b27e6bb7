"""Queries over shard packing, archives and the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.operators import packing
from corpusmill.plans import views as V
from corpusmill.plans.build import build_dataset, count_tree, stats_tree
from corpusmill.plans.q_files import STATS_SQL
from corpusmill.plans.registry import query
from corpusmill.sinks import shards, tables

# Scaled so that the small tables fill many shards and files are refused by the upper bound.
TARGET, LOW, HIGH = 20_000, 5_000, 22_000


def _assigned(index: DataFrame) -> DataFrame:
    staged = staging.stage(index, "index")
    return packing.assign_shards(staged, target=TARGET, min_size=LOW, max_size=HIGH)


def _walk(views: str, source: str, body: str) -> str:
    return f"WITH RECURSIVE {views}, {V.packing_sql(source, TARGET, LOW, HIGH)} {body}"


@query(
    "assign_shards_exact",
    _walk(V.INDEX_SQL, "v_index", "SELECT project_name, file_path, tokens, size, sha256, shard_id FROM v_assigned"),
)
def assign_shards_exact(spark, sf):
    return _assigned(V.document_index(spark, sf))


@query(
    "assign_shards_prefix",
    f"""WITH {V.INDEX_SQL} SELECT project_name, file_path, tokens, size, sha256,
      printf('%05d', CAST((sum(size) OVER (ORDER BY project_name, file_path) - size) // {TARGET} AS BIGINT)) AS shard_id FROM v_index""",
)
def assign_shards_prefix(spark, sf):
    return packing.assign_shards_prefix(staging.stage(V.document_index(spark, sf), "index"), target=TARGET)


@query(
    "shard_stats",
    _walk(
        V.INDEX_SQL,
        "v_index",
        """SELECT shard_id, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, CAST(sum(tokens) AS BIGINT) AS tokens
        FROM v_assigned GROUP BY shard_id""",
    ),
)
def shard_stats(spark, sf):
    return packing.shard_stats(_assigned(V.document_index(spark, sf)))


@query(
    "shards_pending",
    _walk(
        V.INDEX_SQL,
        "v_index",
        """SELECT project_name, file_path, tokens, size, sha256, shard_id FROM v_assigned
        WHERE shard_id NOT IN (SELECT printf('%05d', o_orderkey) FROM orders WHERE o_orderstatus <> 'P'
          INTERSECT SELECT printf('%05d', c_custkey) FROM customer WHERE c_acctbal > 0)""",
    ),
)
def shards_pending(spark, sf):
    """Manifest and archive listing of an earlier run, told from order and customer numbers."""
    number = F.format_string("%05d", "n")
    listed = V.table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("n"))
    stored = V.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("n"))
    return shards.pending_shards(
        _assigned(V.document_index(spark, sf)),
        listed.select(number.alias("shard_id")),
        stored.select(number.alias("shard_id")),
    )


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of the strictly valid files of the tree."""
    return shards.write_shards(
        staging.stage(_assigned(V.tree_index(spark, sf)), "assigned"),
        root=V.tree_folder(spark, sf),
        archives=staging.new_path(spark, "archives"),
        manifest=staging.new_path(spark, "manifest"),
    )


_FINAL = "SELECT project_name, file_path, tokens, size, sha256, shard_id FROM v_assigned"


@query("shard_archive", _walk(V.STRICT_SQL.lstrip(), "v_strict", _FINAL))
def shard_archive(spark, sf):
    return _manifest(spark, sf)


@query(
    "shard_manifest",
    _walk(
        V.STRICT_SQL.lstrip(),
        "v_strict",
        """SELECT shard_id, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, min(sha256) AS lowest_hash
        FROM v_assigned GROUP BY shard_id""",
    ),
)
def shard_manifest(spark, sf):
    return _manifest(spark, sf).groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.min("sha256").alias("lowest_hash")
    )


@query("final_metadata", _walk(V.STRICT_SQL.lstrip(), "v_strict", _FINAL))
def final_metadata(spark, sf):
    return tables.write_final(_manifest(spark, sf), staging.new_path(spark, "final"))


@query("dataset_build", _walk(V.STRICT_SQL.lstrip(), "v_strict", _FINAL))
def dataset_build(spark, sf):
    """The whole build over the tree of files, from the scan to the final table."""
    out = staging.new_path(spark, "build")
    sizes = {"target": TARGET, "min_size": LOW, "max_size": HIGH}
    return build_dataset(spark, V.tree_folder(spark, sf), out, **sizes).final


@query("tree_token_counts", f"WITH {V.COUNTED_SQL} SELECT project_name, tokens, files_processed FROM v_counted")
def tree_token_counts(spark, sf):
    return count_tree(spark, V.tree_folder(spark, sf))


@query(
    "tree_repo_stats",
    f"""WITH {STATS_SQL.strip()}
    SELECT * FROM v_stats WHERE dir_name NOT LIKE '.%'""",
)
def tree_repo_stats(spark, sf):
    """Statistics of the projects of the tree of files, content read for countable files only."""
    return stats_tree(spark, V.tree_folder(spark, sf))
