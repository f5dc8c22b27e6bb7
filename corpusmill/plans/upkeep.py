"""Jobs that carry state from run to run: the list of repositories to clone, and token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.functions.tokens import Tokenizer
from corpusmill.operators import rollup
from corpusmill.operators.discovery import new_hits
from corpusmill.plans.build import count_tree
from corpusmill.schemas import HIT
from corpusmill.sinks import tables
from corpusmill.sources import state, tree


def read_clone_list(spark: SparkSession, path: str) -> DataFrame:
    """Repositories found so far; empty before the first run."""
    if not state.path_exists(spark, path):
        return spark.createDataFrame([], HIT)
    return spark.read.schema(HIT).parquet(path)


def extend_clone_list(hits: DataFrame, path: str, cloned: DataFrame, order_by: list[str]) -> DataFrame:
    """Append the first hit of every repository that is neither listed nor cloned yet.

    ``hits`` are landed results (``full_name, clone_url, stars`` and the columns of
    ``order_by``). Only new rows are written, so a run costs what it finds. Returns those rows.
    """
    listed = read_clone_list(hits.sparkSession, path)
    found = new_hits(hits, listed, cloned, "full_name", order_by).select(*HIT.fieldNames()).to(HIT)
    fresh = staging.stage(found, "fresh-hits")
    fresh.write.mode("append").parquet(path)
    return fresh


def update_token_counts(
    spark: SparkSession, root: str, summary: str, *, tokenizer: Tokenizer = "regex"
) -> DataFrame:
    """Count the projects below ``root`` that the summary lacks and write it anew.

    The repository total is the number of project directories, counted or not.
    """
    stored = state.read_token_counts(spark, summary)
    counted = count_tree(spark, root, already=stored, tokenizer=tokenizer)
    whole = staging.stage(rollup.add_rollups(stored, counted), "token-counts")
    projects = tree.list_projects(spark, root).count()
    totals = rollup.summary_totals(whole).withColumn("total_repos", F.lit(projects).cast("long"))
    tables.write_summary(whole, summary, totals)
    return whole
