"""Totals per project and over the corpus, and their comparison with expected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.units import gib


def project_rollup(index: DataFrame) -> DataFrame:
    """Tokens and files of every project."""
    return index.groupBy("project_name").agg(
        F.sum("tokens").alias("tokens"), F.count("file_path").alias("files_processed")
    )


def corpus_totals(index: DataFrame) -> DataFrame:
    """One row: files, tokens, bytes and projects. Counts projects from the pre-aggregated
    roll-up, so that no row-level distinct is shuffled."""
    per_project = index.groupBy("project_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("tokens").alias("tokens"), F.sum("size").alias("bytes")
    )
    return per_project.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.count("project_name").alias("total_repos"),
    ).withColumn("total_gib", gib(F.col("total_bytes")))


def summary_totals(rollup: DataFrame) -> DataFrame:
    """One row with the totals of a per-project table."""
    return rollup.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        F.count("project_name").alias("total_repos"),
        F.coalesce(F.sum("files_processed"), F.lit(0)).alias("total_files"),
    )


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare two one-row totals (``total_tokens, total_files``); no row if nothing is expected."""
    names = {"total_tokens": "tokens", "total_files": "files"}
    both = actual.select(*[F.col(c).alias(f"actual_{n}") for c, n in names.items()]).unionByName(
        expected.select(*[F.col(c).alias(f"expected_{n}") for c, n in names.items()]),
        allowMissingColumns=True,
    )
    sides = both.agg(*[F.max(c).alias(c) for c in both.columns])  # one row from each side
    sides = sides.filter("expected_tokens IS NOT NULL AND expected_files IS NOT NULL")
    return sides.select(
        "expected_tokens",
        "actual_tokens",
        (F.col("actual_tokens") - F.col("expected_tokens")).alias("tokens_diff"),
        (F.col("actual_tokens") == F.col("expected_tokens")).alias("tokens_match"),
        "expected_files",
        "actual_files",
        (F.col("actual_files") - F.col("expected_files")).alias("files_diff"),
        (F.col("actual_files") == F.col("expected_files")).alias("files_match"),
        (F.col("actual_files") < F.col("expected_files")).alias("lower_is_expected"),
    )


def reconcile_projects(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare two per-project tables (``project_name, tokens, files_processed``), a row for each project
    of either. What one side lacks is null there, counts as 0 in the differences, and never matches."""
    sides = [
        side.select("project_name", F.col("tokens").alias(f"{n}_tokens"), F.col("files_processed").alias(f"{n}_files"), F.lit(True).alias(f"_{n}"))
        for n, side in (("actual", actual), ("expected", expected))
    ]
    both = sides[0].join(sides[1], "project_name", "full_outer")
    known = F.col("_actual").isNotNull() & F.col("_expected").isNotNull()

    def compared(what: str) -> list[Column]:
        own, wanted = F.col(f"actual_{what}"), F.col(f"expected_{what}")
        difference = F.coalesce(own, F.lit(0)) - F.coalesce(wanted, F.lit(0))
        return [wanted, own, difference.alias(f"{what}_diff"), (known & own.eqNullSafe(wanted)).alias(f"{what}_match")]

    side = F.when(known, "both").when(F.col("_actual"), "actual").otherwise("expected")
    return both.select("project_name", side.alias("side"), *compared("tokens"), *compared("files"))


def summary_lines(rollup: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """The summary document as text lines: ``part, project_name, line``.

    Part 0 is the head with the totals, part 1 one line per project, part 2 the foot. In the
    order of part and project the lines are one JSON document, so it can be written by many
    tasks and no task holds all projects.
    """
    totals = summary_totals(rollup) if totals is None else totals
    head_json = F.to_json(F.struct("total_tokens", "total_repos", "total_files"))
    head = totals.select(
        F.lit(0).alias("part"),
        F.lit("").alias("project_name"),
        F.concat(F.regexp_replace(head_json, r"\}$", ""), F.lit(',"repos":{')).alias("line"),
    )
    first = rollup.agg(F.min("project_name").alias("project_name")).withColumn("_first", F.lit(True))
    named = F.regexp_extract(F.to_json(F.struct(F.col("project_name").alias("n"))), r'(?s)^\{"n":(.*)\}$', 1)
    entry = F.concat(
        F.when(F.col("_first"), "").otherwise(","),
        named,
        F.lit(":"),
        F.to_json(F.struct("tokens", "files_processed")),
    )
    body = rollup.join(first, "project_name", "left").select(
        F.lit(1).alias("part"), "project_name", entry.alias("line")
    )
    foot = totals.select(F.lit(2).alias("part"), F.lit("").alias("project_name"), F.lit("}}").alias("line"))
    return head.unionByName(body).unionByName(foot)


def add_rollups(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored per-project totals plus those of newly counted projects."""
    return (
        stored.unionByName(new)
        .groupBy("project_name")
        .agg(F.sum("tokens").alias("tokens"), F.sum("files_processed").alias("files_processed"))
    )
