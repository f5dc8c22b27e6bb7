"""What to keep of a cloned repository, what counts, and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import (
    ALWAYS_KEEP_NAMES,
    BACKFILL_NOTE,
    CODE_EXTENSIONS,
    JSON_SIZE_CAP,
    MAX_CONTENT_CHARS,
    MAX_FILE_SIZE,
    TEXT_EXTENSIONS,
    TXT_SIZE_CAP,
)
from corpusmill.functions import paths, text
from corpusmill.functions.tokens import Tokenizer, count_tokens
from corpusmill.schemas import REPO


def extension_class(ext: Column) -> Column:
    """``code``, ``text``, ``none`` (no suffix) or ``other``."""
    return (
        F.when(ext == "", "none")
        .when(ext.isin(CODE_EXTENSIONS), "code")
        .when(ext.isin(TEXT_EXTENSIONS), "text")
        .otherwise("other")
    )


def purge_action(
    file_path: Column,
    size: Column,
    *,
    name: Column | None = None,
    ext: Column | None = None,
    txt_cap: int = TXT_SIZE_CAP,
    json_cap: int = JSON_SIZE_CAP,
) -> Column:
    """``ignore`` under ``.git``, else ``keep`` or ``drop``. ``name`` and ``ext`` of the file, if there
    are columns for them, are not worked out again for every use."""
    name = paths.basename(file_path) if name is None else name
    ext = paths.suffix(name) if ext is None else ext
    oversized = ((ext == ".txt") & (size > txt_cap)) | ((ext == ".json") & (size > json_cap))
    return (
        F.when(paths.under_git(file_path), "ignore")
        .when(name.isin(ALWAYS_KEEP_NAMES) | F.upper(name).isin(ALWAYS_KEEP_NAMES), "keep")
        .when(oversized, "drop")
        .when(extension_class(ext) != "other", "keep")
        .otherwise("drop")
    )


def purge_plan(listing: DataFrame, **caps: int) -> DataFrame:
    """Listing with the decision on every file."""
    named = listing.withColumn("_name", paths.basename(F.col("file_path")))
    typed = named.withColumn("_ext", paths.suffix(F.col("_name")))
    action = purge_action(F.col("file_path"), F.col("size"), name=F.col("_name"), ext=F.col("_ext"), **caps)
    return typed.withColumn("action", action).drop("_name", "_ext")


def purge_stats(plan: DataFrame) -> DataFrame:
    """Files and bytes a purge would free, per project directory."""
    drop = F.col("action") == "drop"
    return plan.groupBy("dir_name").agg(
        F.count_if(drop).alias("files_deleted"),
        F.sum(F.when(drop, F.col("size")).otherwise(0)).alias("bytes_freed"),
    )


def token_eligible(
    ext: Column, size: Column, *, txt_cap: int = TXT_SIZE_CAP, size_cap: int = MAX_FILE_SIZE
) -> Column:
    """Whether a file is small enough for its kind to be tokenized."""
    return F.when(ext == ".txt", size <= F.least(F.lit(txt_cap), F.lit(size_cap))).otherwise(size <= size_cap)


def token_counter(
    files: DataFrame,
    projects: DataFrame,
    *,
    max_size: int = MAX_FILE_SIZE,
    max_chars: int = MAX_CONTENT_CHARS,
    tokenizer: Tokenizer = "regex",
) -> DataFrame:
    """Lossy token count of all non-empty files of each project.

    ``files`` holds ``dir_name, file_path, size, content``; ``projects`` the project directories
    to count. A project without a countable file still gets a row of zeros. Files are joined to
    projects after they have been added up, so content never reaches a shuffle; leave files of
    other projects out before their content is read (:func:`uncounted`).
    """
    body = text.truncate(text.lossy_text(F.col("content")), max_chars)
    some = F.length("text") > 0
    wanted_text = F.when(some, F.col("text"))  # null, so that no tokenizer sees an empty text
    counted = (
        files.filter(~paths.under_git_like(F.col("dir_name"), F.col("file_path")) & (F.col("size") <= max_size))
        .withColumn("text", body)
        .select("dir_name", count_tokens(wanted_text, tokenizer).alias("tokens"), some.alias("some"))
        .groupBy("dir_name")
        .agg(F.sum("tokens").alias("tokens"), F.count_if("some").alias("files_processed"))
    )
    wanted = projects.filter(~paths.is_hidden(F.col("dir_name"))).select("dir_name")
    return wanted.join(counted, "dir_name", "left").select(
        paths.dir_to_project(F.col("dir_name")).alias("project_name"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("files_processed", F.lit(0)).alias("files_processed"),
    )


def uncounted(rows: DataFrame, already: DataFrame) -> DataFrame:
    """Rows of a listing, or of a project list, whose project ``already`` does not name."""
    named = rows.withColumn("_project", paths.dir_to_project(F.col("dir_name")))
    done = already.select(F.col("project_name").alias("_project"))
    return named.join(done, "_project", "left_anti").select(*rows.columns)


def file_tokens(
    files: DataFrame,
    *,
    txt_cap: int = TXT_SIZE_CAP,
    size_cap: int = MAX_FILE_SIZE,
    max_chars: int = MAX_CONTENT_CHARS,
    tokenizer: Tokenizer = "regex",
) -> DataFrame:
    """Add ``ext``, ``class`` and ``tokens``; 0 for files that are not to be tokenized."""
    ext = paths.suffix(paths.basename(F.col("file_path")))
    typed = files.withColumn("ext", ext).withColumn("class", extension_class(F.col("ext")))
    counts = F.col("class").isin("code", "text") & token_eligible(
        F.col("ext"), F.col("size"), txt_cap=txt_cap, size_cap=size_cap
    )
    lossy = F.when(counts, text.lossy_text(F.col("content")))
    # blanked before the call, as a tokenizer in Python sees every row
    fitting = F.when(text.within_length(F.col("_lossy"), max_chars), F.col("_lossy"))
    return (
        typed.withColumn("_lossy", lossy)
        .withColumn("_text", fitting)
        .withColumn("tokens", F.coalesce(count_tokens(F.col("_text"), tokenizer), F.lit(0).cast("long")))
        .drop("_lossy", "_text")
    )


def listing_stats(planned: DataFrame) -> DataFrame:
    """Files and bytes of every project directory, of a listing with ``_dropped``."""
    kept = ~F.col("_dropped")
    return planned.groupBy("dir_name").agg(
        F.count_if(kept).alias("total_files"),
        F.sum(F.when(kept, F.col("size")).otherwise(0)).alias("size_bytes"),
        F.count_if(F.col("_dropped")).alias("files_deleted"),
        F.sum(F.when(F.col("_dropped"), F.col("size")).otherwise(0)).alias("bytes_freed"),
    )


def content_stats(counted: DataFrame) -> DataFrame:
    """Tokens of every project directory, of files with ``class`` and ``tokens``."""
    some = F.col("tokens") > 0
    return counted.groupBy("dir_name").agg(
        F.count_if(some & (F.col("class") == "code")).alias("python_files"),
        F.sum("tokens").alias("tokens"),
        F.count_if(some).alias("files_processed"),
    )


def with_dropped(files: DataFrame, purge: bool, caps: dict[str, int] | None) -> DataFrame:
    """Add ``_dropped``: whether a purge removes the file."""
    planned = purge_plan(files, **(caps or {}))
    return planned.withColumn("_dropped", (F.col("action") == "drop") & F.lit(purge)).drop("action")


STATS = "total_files python_files tokens size_bytes files_deleted bytes_freed files_processed".split()


def joined_stats(projects: DataFrame | None, listed: DataFrame, counted: DataFrame) -> DataFrame:
    """Both halves of the statistics; a project of ``projects`` without files gets zeros."""
    rows = listed if projects is None else projects.select("dir_name").join(listed, "dir_name", "left")
    whole = rows.join(counted, "dir_name", "left")
    return whole.select("dir_name", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in STATS))


def repo_stats(
    files: DataFrame,
    projects: DataFrame | None = None,
    *,
    purge: bool = True,
    caps: dict[str, int] | None = None,
    **options,
) -> DataFrame:
    """Statistics of every project directory, after a purge unless ``purge`` is off.

    Everything that is left counts towards files and bytes, ``.git`` included. Tokens count for
    code and text suffixes; ``python_files`` are code files of any language with tokens. With
    ``projects`` every project of that list has a row. For files on storage see
    :func:`corpusmill.plans.build.stats_tree`, which reads the content of countable files only.
    """
    dropped = with_dropped(files, purge, caps)
    counted = file_tokens(dropped.filter(~F.col("_dropped")), **options)
    return joined_stats(projects, listing_stats(dropped), content_stats(counted))


def countable(listing: DataFrame, *, txt_cap: int = TXT_SIZE_CAP, size_cap: int = MAX_FILE_SIZE) -> DataFrame:
    """Files of a listing whose content the statistics need."""
    ext = paths.suffix(paths.basename(F.col("file_path")))
    typed = listing.withColumn("_ext", ext)
    small = token_eligible(F.col("_ext"), F.col("size"), txt_cap=txt_cap, size_cap=size_cap)
    return typed.filter(extension_class(F.col("_ext")).isin("code", "text") & small).drop("_ext")


def recalc_totals(db: DataFrame, stored_tokens: Column) -> DataFrame:
    """Totals from the nested statistics, and whether the stored token total has drifted."""
    return db.agg(
        F.coalesce(F.sum("stats.tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("stats.python_files"), F.lit(0)).alias("python_files"),
        F.count(F.lit(1)).alias("repos"),
        F.max(stored_tokens).alias("stored_tokens"),
    ).withColumn("drifted", F.col("total_tokens") != F.col("stored_tokens"))


def backfill_repos(stats: DataFrame, db: DataFrame, *, root: str, at: Column) -> DataFrame:
    """Records of projects that are on storage but not in ``db``, added to ``db``."""
    fields = REPO["stats"].dataType.fieldNames()
    new = stats.select(
        paths.dir_to_project(F.col("dir_name")).alias("full_name"),
        F.lit("unknown").alias("url"),
        F.concat(F.lit(root.rstrip("/") + "/"), "dir_name").alias("path"),
        F.struct(*fields).alias("stats"),
        at.alias("cloned_at"),
        F.lit(0).cast("long").alias("stars"),
        F.lit(0).cast("long").alias("forks"),
        F.lit(0).cast("long").alias("size"),
        F.lit(BACKFILL_NOTE).alias("note"),
    ).join(db.select("full_name"), "full_name", "left_anti")
    return db.to(REPO).unionByName(new.to(REPO))


def upsert_repos(records: DataFrame, updates: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Last write wins per ``full_name``, by ``cloned_at`` unless other columns are named; a tie
    goes to the update."""
    order = order_by or ["cloned_at"]
    both = records.withColumn("_late", F.lit(0)).unionByName(updates.withColumn("_late", F.lit(1)))
    whole = F.struct(*records.columns)
    return (
        both.groupBy("full_name")
        .agg(F.max_by(whole, F.struct(*order, "_late")).alias("_last"))
        .select("_last.*")
    )
