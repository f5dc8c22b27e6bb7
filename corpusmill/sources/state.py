"""State documents and landed search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import staging, storage
from corpusmill.functions import html as H
from corpusmill.functions.search import clone_url
from corpusmill.schemas import FILE_CHUNK, PROJECT_TOTALS, RAW_PAGE, TOKEN_COUNTS
from corpusmill.sources import json_entries
from corpusmill.sources.tree import list_directory, list_projects
from corpusmill.storage import Clients

#: Row groups that a task reads one after the other.
GROUPS_PER_TASK = 16


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any storage Spark can reach."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_chunks(spark: SparkSession, path: str, *, skip_corrupt: bool = False) -> DataFrame:
    """Metadata chunks of a folder. A broken chunk fails the job unless ``skip_corrupt``."""
    reader = spark.read.schema(FILE_CHUNK).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return reader.parquet(path)


def corrupt_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``file, error`` of the chunks that ``skip_corrupt`` would leave out: those whose Parquet footer
    cannot be read. Each chunk is looked at by one task, footers only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    paths = files.load(path).select("path")

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        clients = Clients()
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                filesystem, inner = clients.at(name)
                try:
                    pq.ParquetFile(inner, filesystem=filesystem).metadata  # noqa: B018
                except (pa.ArrowInvalid, OSError) as error:
                    found.append({"file": name, "error": str(error)})
            if found:
                yield pa.RecordBatch.from_pylist(found)

    return paths.mapInArrow(run, "file string, error string")


def read_sound_chunks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all sound row groups of the metadata chunks at ``path``, and ``file, row_group, error`` of
    the damaged ones; a chunk whose footer cannot be read has row group -1.

    Row groups are dealt out and read one by one, each whole before any of its rows counts, so damage in
    one costs no other. Both tables come from one staged reading. Columns that a chunk lacks are null.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    top = spark.createDataFrame([(storage.qualified(spark, path),)], "path string")
    layout = to_arrow_schema(FILE_CHUNK)

    def opened(name: str, clients: Clients):
        import pyarrow.parquet as pq

        filesystem, inner = clients.at(name)
        return pq.ParquetFile(inner, filesystem=filesystem)

    def listed(batches):
        """Names alone, empty files too, which Spark's own readers pass over."""
        import pyarrow as pa

        clients = Clients()
        for batch in batches:
            folders = batch.column(0).to_pylist()
            while folders:
                folder, found = folders.pop(), []
                for name, is_dir, _ in list_directory(folder, clients):
                    if is_dir:
                        folders.append(f"{folder}/{name}")
                    elif name.endswith(".parquet") and name[0] not in "._":
                        found.append(f"{folder}/{name}")
                if found:
                    yield pa.RecordBatch.from_pydict({"path": found})

    def plan(batches):
        import pyarrow as pa

        clients, schema = Clients(), pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("error", pa.string())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    with opened(name, clients) as chunk:
                        found = [(name, i, None) for i in range(chunk.num_row_groups)]
                except (pa.ArrowException, OSError) as error:
                    found = [(name, -1, str(error))]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, f, strict=True)) for f in found], schema=schema)

    def read(batches):
        import pyarrow as pa

        clients = Clients()
        for batch in batches:
            for row in batch.to_pylist():
                error, table = row["error"], layout.empty_table()
                if error is None:
                    try:
                        with opened(row["file"], clients) as chunk:
                            known = [c for c in layout.names if c in chunk.schema_arrow.names]
                            got = chunk.read_row_group(row["row_group"], columns=known)
                        got.validate(full=True)
                        columns = [
                            got.column(f.name).cast(f.type) if f.name in known else pa.nulls(got.num_rows, f.type) for f in layout
                        ]
                        table = pa.Table.from_arrays(columns, schema=layout)
                    except (pa.ArrowException, OSError) as reason:
                        error = str(reason)
                if error is not None:  # a row of its own, without values
                    table = pa.Table.from_arrays([pa.nulls(1, f.type) for f in layout], schema=layout)
                notes = [("file", row["file"], pa.string()), ("row_group", row["row_group"], pa.int32()), ("error", error, pa.string())]
                for name, value, kind in notes:
                    table = table.append_column(f"_{name}", pa.array([value] * table.num_rows, kind))
                yield from table.combine_chunks().to_batches()

    names = staging.stage(top.mapInArrow(listed, "path string"), "chunk-names")
    spread = names.repartition(spark.sparkContext.defaultParallelism, "path")
    planned = staging.stage(spread.mapInArrow(plan, "file string, row_group int, error string"), "row-groups")
    tasks = max(spark.sparkContext.defaultParallelism, planned.count() // GROUPS_PER_TASK)
    noted = T.StructType(FILE_CHUNK.fields + [T.StructField(f"_{n}", k) for n, k in (("file", T.StringType()), ("row_group", T.IntegerType()), ("error", T.StringType()))])
    outcome = staging.stage(planned.repartition(tasks, "file", "row_group").mapInArrow(read, noted), "sound-rows")
    rows = outcome.filter("_error IS NULL").select(*FILE_CHUNK.fieldNames())
    damage = outcome.filter("_error IS NOT NULL").select(F.col("_file").alias("file"), F.col("_row_group").alias("row_group"), F.col("_error").alias("error"))
    return rows, damage


def read_summary(
    spark: SparkSession, path: str, *, split_bytes: int = json_entries.SPLIT_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Head totals (``total_tokens, total_repos, total_files``) and per-project totals of a summary.

    Reads both layouts: one JSON document per file, in splits of ``split_bytes``, and the text lines that
    :func:`corpusmill.sinks.tables.write_summary` writes in any number of parts. Of a name that comes twice
    in a document the last one counts. Both tables are empty if the document is missing or broken; the totals are empty too if it lacks either of the
    two that are compared.
    """
    totals = T.StructType([f for f in TOKEN_COUNTS.fields if f.name != "repos"])
    no_repos = spark.createDataFrame([], "project_name string, tokens long, files_processed long")
    if not path_exists(spark, path):
        return spark.createDataFrame([], totals), no_repos
    lines = spark.read.text(path)
    # only our own layout has such a first line, and a last line of these two characters
    head = lines.filter(F.startswith("value", F.lit('{"total_')) & F.endswith("value", F.lit(',"repos":{')))
    foot = lines.filter("value = '}}'")
    if not head.isEmpty() and not foot.isEmpty():
        found = F.from_json(F.concat("value", F.lit("}}")), totals)
        heads = head.select(found.alias("t")).select("t.*")
        body = lines.filter(F.startswith(F.ltrim(F.col("value"), F.lit(",")), F.lit('"')))
        entry = F.from_json(
            F.concat(F.lit("{"), F.ltrim(F.col("value"), F.lit(",")), F.lit("}")),
            T.MapType(T.StringType(), PROJECT_TOTALS),
        )
        repos = body.select(F.explode(entry).alias("project_name", "totals"))
    else:
        found = json_entries.read_members(spark, path, split_bytes=split_bytes)
        broken = found.filter("NOT sound").select("file").distinct()
        whole = found.join(F.broadcast(broken), "file", "left_anti")  # one row for each broken document
        number = F.from_json(F.concat(F.lit('{"v":'), "value", F.lit("}")), "v long")["v"]
        named = [F.max_by(F.when(F.col("name") == c, number), F.when(F.col("name") == c, F.col("at"))).alias(c) for c in totals.fieldNames()]
        heads = whole.filter("depth = 1").groupBy("file").agg(*named).drop("file")
        last = whole.filter("depth = 2 AND parent = 'repos'").groupBy("file", "name").agg(F.max_by("value", "at").alias("value"))
        repos = last.select(F.col("name").alias("project_name"), F.from_json("value", PROJECT_TOTALS).alias("totals"))
    return heads.filter("total_tokens IS NOT NULL AND total_files IS NOT NULL"), _totals(repos)


def _totals(repos: DataFrame) -> DataFrame:
    return repos.select(
        "project_name",
        F.coalesce("totals.tokens", F.lit(0)).alias("tokens"),
        F.coalesce("totals.files_processed", F.lit(0)).alias("files_processed"),
    )


def read_token_counts(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Per-project totals of a summary document, empty if it is missing or broken.

    ``lines``: the files hold one document per line instead of one in all.
    """
    if not lines:
        return read_summary(spark, path)[1]
    documents = spark.read.schema(TOKEN_COUNTS).json(path)
    return _totals(documents.select(F.explode("repos").alias("project_name", "totals")))


def read_names(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """A state set: the strings of a JSON array in any line layout. Empty if missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{name} string")
    quoted = F.regexp_extract_all("value", F.lit(r'"(?:[^"\\]|\\.)*"'), F.lit(0))
    words = spark.read.text(path).select(F.explode_outer(quoted).alias("word")).filter("word IS NOT NULL")
    plain = F.from_json(F.concat(F.lit('{"v":'), "word", F.lit("}")), "v string")["v"]
    return words.select(plain.alias(name)).distinct()


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill fields an older document lacks; fields that are present stay as they are."""
    return df.select(
        *[
            F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ]
    )


def read_state(
    spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, Column]
) -> DataFrame:
    """State documents, one per line, brought to ``schema`` and filled up with ``defaults``."""
    return with_defaults(spark.read.schema(schema).json(path), defaults)


def cloned_set(spark: SparkSession, root: str) -> DataFrame:
    """Projects already on storage, told from their directories."""
    return list_projects(spark, root).select(F.col("project_name").alias("full_name"))


def read_raw_hits(spark: SparkSession, path: str) -> DataFrame:
    """Landed API pages, one JSON document per line → one row per item."""
    return raw_hits(spark.read.schema(RAW_PAGE).json(path))


def raw_hits(pages: DataFrame) -> DataFrame:
    """One row per item of a result page, with its place on the page."""
    return pages.select(
        "query", "sort", "page", "total_count", F.posexplode("items").alias("position", "item")
    ).select(
        "query",
        "sort",
        "page",
        "total_count",
        "position",
        F.col("item.id").cast("string").alias("repo_id"),
        F.col("item.full_name").alias("full_name"),
        F.col("item.clone_url").alias("clone_url"),
        F.coalesce("item.stargazers_count", F.lit(0)).alias("stars"),
        F.coalesce("item.forks_count", F.lit(0)).alias("forks"),
        F.coalesce("item.size", F.lit(0)).alias("size"),
    )


def html_records(pages: DataFrame, *, html: str = "html", pattern: str = H.RECORD_PATTERN) -> DataFrame:
    """Landed HTML pages → one row per record in page order, with its star count."""
    keys = [c for c in pages.columns if c != html]
    found = H.with_matches(pages, html, pattern).withColumn(
        "records", H.record_array(F.col(html), F.col("matches"))
    )
    # the outer form keeps the optimizer from working the records out a second time to test
    # for empty pages below the generator
    return found.select(*keys, F.inline_outer("records")).filter("position IS NOT NULL")


def page_hits(pages: DataFrame, *, html: str = "html", pattern: str = H.RECORD_PATTERN) -> DataFrame:
    """Accepted records of each page: distinct names, at most ten, best position first."""
    keys = [c for c in pages.columns if c != html]
    found = H.with_matches(pages, html, pattern).withColumn(
        "records", H.accepted(H.record_array(F.col(html), F.col("matches")))
    )
    ranked = found.select(*keys, F.posexplode_outer("records").alias("rank", "r")).filter("rank IS NOT NULL")
    return ranked.select(
        *keys,
        F.col("rank"),
        F.col("r.name").alias("full_name"),
        clone_url(F.col("r.name")).alias("clone_url"),
        F.col("r.stars").alias("stars"),
    )


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """A topic list, one per line."""
    return topics(spark.read.text(path).select(F.trim("value").alias("topic")).filter("topic <> ''"))


def topics(words: DataFrame, column: str = "topic") -> DataFrame:
    """Distinct topics of a column."""
    return words.select(F.col(column).alias("topic")).filter(F.col("topic").isNotNull()).distinct()
