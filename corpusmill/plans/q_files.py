"""Queries over file trees, text rules, metadata and scalar functions."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusmill import constants as C
from corpusmill import staging
from corpusmill.functions import paths, text, tokens, units
from corpusmill.operators import extract, ordering, repo_stats, rollup
from corpusmill.plans import views as V
from corpusmill.plans.registry import query
from corpusmill.sinks import tables
from corpusmill.sources import code_tree, state, tree

# Scaled limits: documents are far smaller than the real caps, so the queries about a cap use
# smaller ones. Queries that compose rules use the real caps.
FILE_CAP, TXT_CAP, JSON_CAP, CHAR_CAP = 8_000, 2_000, 4_000, 6_000

FILE = ["dir_name", "file_path", "size"]


def _with(sql: str, body: str) -> str:
    return f"WITH {sql} {body}"


# --- listing and reading --------------------------------------------------------------


@query(
    "projects_list",
    _with(V.TREE_SQL, "SELECT DISTINCT dir_name, project_name FROM v_tree WHERE dir_name NOT LIKE '.%'"),
)
def projects_list(spark, sf):
    return tree.list_projects(spark, V.tree_folder(spark, sf))


@query(
    "tree_scan",
    _with(V.TREE_SQL, "SELECT dir_name, file_path, name, size FROM v_tree WHERE dir_name NOT LIKE '.%'"),
)
def tree_scan(spark, sf):
    return code_tree.load_tree(spark, V.tree_folder(spark, sf))


@query(
    "tree_content",
    _with(
        V.TREE_SQL,
        r"""SELECT dir_name, file_path, size, kind = 'nul' AS has_nul, kind <> 'bad' AS is_utf8,
          CASE kind WHEN 'bad' THEN sha256(encode(body) || '\xFF'::BLOB) ELSE sha256(body) END AS sha256
        FROM v_tree WHERE dir_name NOT LIKE '.%'""",
    ),
)
def tree_content(spark, sf):
    root = V.tree_folder(spark, sf)
    content = F.col("content")
    return code_tree.load_tree(spark, root, [*FILE, "content"]).select(
        *FILE,
        text.has_nul(content).alias("has_nul"),
        text.is_utf8(content).alias("is_utf8"),
        text.sha256_hex(content).alias("sha256"),
    )


@query(
    "lossy_text",
    _with(
        V.TREE_SQL,
        "SELECT dir_name, file_path, CAST(length(lossy) AS INTEGER) AS chars, sha256(lossy) AS sha256 FROM v_tree",
    ),
)
def lossy_text(spark, sf):
    files = extract.lossy_content(V.tree_table(spark, sf))
    return files.select(
        "dir_name",
        "file_path",
        F.length("text").alias("chars"),
        text.sha256_hex(F.col("text").cast("binary")).alias("sha256"),
    )


@query(
    "cloned_set",
    _with(V.TREE_SQL, "SELECT DISTINCT project_name AS full_name FROM v_tree WHERE dir_name NOT LIKE '.%'"),
)
def cloned_set(spark, sf):
    return state.cloned_set(spark, V.tree_folder(spark, sf))


@query(
    "total_repos",
    _with(V.TREE_SQL, "SELECT count(DISTINCT dir_name) AS total_repos FROM v_tree WHERE dir_name NOT LIKE '.%'"),
)
def total_repos(spark, sf):
    return tree.list_projects(spark, V.tree_folder(spark, sf)).agg(F.count(F.lit(1)).alias("total_repos"))


# --- filters --------------------------------------------------------------------------


def _filter(name, condition, sql):
    @query(name, _with(V.TREE_SQL, f"SELECT dir_name, file_path, size FROM v_tree WHERE {sql}"))
    def run(spark, sf):
        return V.tree_table(spark, sf).filter(condition()).select(*FILE)

    return run


_filter("filter_size", lambda: F.col("size") <= FILE_CAP, f"size <= {FILE_CAP}")
_filter("filter_binary", lambda: ~text.has_nul(F.col("content")), "kind <> 'nul'")
_filter("filter_utf8", lambda: text.is_utf8(F.col("content")), "kind <> 'bad'")
_filter("filter_py", lambda: F.endswith("file_path", F.lit(".py")), "right(file_path, 3) = '.py'")
_filter(
    "filter_git_substr",
    lambda: ~paths.under_git_like(F.col("dir_name"), F.col("file_path")),
    "strpos(dir_name || '/' || parent, '.git') = 0",
)
_filter(
    "filter_git_component",
    lambda: ~paths.under_git(F.col("file_path")),
    "NOT list_contains(string_split(file_path, '/'), '.git')",
)
_filter("filter_hidden", lambda: ~paths.is_hidden(F.col("dir_name")), "substr(dir_name, 1, 1) <> '.'")
_filter(
    "filter_nonempty",
    lambda: F.length(text.lossy_text(F.col("content"))) > 0,
    "length(lossy) > 0",
)
_filter(
    "cap_skip",
    lambda: text.within_length(text.lossy_text(F.col("content")), CHAR_CAP),
    f"length(lossy) <= {CHAR_CAP}",
)


@query(
    "cap_truncate",
    _with(
        V.TREE_SQL,
        f"""SELECT dir_name, file_path, length(lossy) > {CHAR_CAP} AS truncated,
          sha256(substr(lossy, 1, {CHAR_CAP})) AS sha256 FROM v_tree""",
    ),
)
def cap_truncate(spark, sf):
    lossy = text.lossy_text(F.col("content"))
    return V.tree_table(spark, sf).withColumn("lossy", lossy).select(
        "dir_name",
        "file_path",
        (F.length("lossy") > CHAR_CAP).alias("truncated"),
        text.sha256_hex(text.truncate(F.col("lossy"), CHAR_CAP).cast("binary")).alias("sha256"),
    )


# --- metadata, chunks, index ----------------------------------------------------------

_META = """SELECT project_name, file_path AS relative_path, size AS file_size, sha256,
  tokens AS token_count FROM v_strict"""


@query(
    "extract_metadata",
    _with(
        V.STRICT_SQL,
        """SELECT project_name, file_path AS relative_path, size AS file_size, sha256, tokens AS token_count,
          '/data/' || regexp_replace(project_name, '/', '_') || '/' || file_path AS absolute_path FROM v_strict""",
    ),
)
def extract_metadata(spark, sf):
    return V.tree_metadata(spark, sf)


@query(
    "drop_reasons",
    _with(
        V.TREE_SQL,
        f""", v_reason AS (SELECT CASE WHEN substr(dir_name, 1, 1) = '.' THEN 'hidden'
            WHEN strpos(dir_name || '/' || parent, '.git') > 0 THEN 'git' WHEN right(file_path, 3) <> '.py' THEN 'suffix'
            WHEN size > {FILE_CAP} THEN 'size' WHEN kind = 'nul' THEN 'binary' WHEN kind = 'bad' THEN 'encoding' ELSE 'kept' END
            AS reason FROM v_tree)
        SELECT r.reason, count(v.reason) AS files
        FROM (VALUES {", ".join(f"('{r}')" for r in extract.REASONS)}) r(reason) LEFT JOIN v_reason v ON v.reason = r.reason
        GROUP BY r.reason""",
    ),
)
def drop_reasons(spark, sf):
    """What the extraction leaves out and why, counted while its result is written."""
    audit = Observation("drop_reasons")
    staging.stage(extract.extract_metadata(V.tree_table(spark, sf), max_size=FILE_CAP, audit=audit), "audited")
    return extract.drop_counts(spark, audit)


@query("chunks_read", _with(V.STRICT_SQL, _META))
def chunks_read(spark, sf):
    path = staging.new_path(spark, "chunks")
    tables.write_chunks(V.tree_metadata(spark, sf), path)
    return state.read_chunks(spark, path).drop("absolute_path")


@query("chunks_sound", _with(V.STRICT_SQL, _META))
def chunks_sound(spark, sf):
    """The chunks read row group by row group; none is damaged."""
    path = staging.new_path(spark, "chunks")
    tables.write_chunks(V.tree_metadata(spark, sf), path)
    rows, damage = state.read_sound_chunks(spark, path)
    assert damage.isEmpty()
    return rows.drop("absolute_path")


@query(
    "chunk_write",
    _with(
        V.STRICT_SQL,
        """, v_numbered AS (SELECT *, (row_number() OVER (ORDER BY project_name, file_path) - 1) // 25 AS batch_id
          FROM v_strict)
        SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS files, CAST(sum(tokens) AS BIGINT) AS tokens,
          min(project_name) AS first_project, max(project_name) AS last_project
        FROM v_numbered GROUP BY batch_id""",
    ),
)
def chunk_write(spark, sf):
    path = staging.new_path(spark, "chunks")
    metadata = staging.stage(V.tree_metadata(spark, sf), "metadata")
    tables.write_chunks(metadata, path, rows_per_file=25, exact=True)
    schema = metadata.schema.add("batch_id", "long")
    return spark.read.schema(schema).parquet(path).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("token_count").alias("tokens"),
        F.min("project_name").alias("first_project"),
        F.max("project_name").alias("last_project"),
    )


_INDEX = """SELECT project_name, file_path, tokens, size, sha256, CAST(NULL AS VARCHAR) AS shard_id FROM v_strict"""


@query("conform_index", _with(V.STRICT_SQL, _INDEX))
def conform_index(spark, sf):
    return V.tree_index(spark, sf)


@query("index_write", _with(V.STRICT_SQL, _INDEX))
def index_write(spark, sf):
    return tables.write_index(V.tree_index(spark, sf), staging.new_path(spark, "index"))


@query(
    "index_read",
    _with(
        V.STRICT_SQL,
        "SELECT project_name, CAST(max(size) AS BIGINT) AS largest, CAST(sum(size) AS BIGINT) AS bytes "
        "FROM v_strict GROUP BY project_name",
    ),
)
def index_read(spark, sf):
    index = tables.write_index(V.tree_index(spark, sf), staging.new_path(spark, "index"))
    return index.groupBy("project_name").agg(F.max("size").alias("largest"), F.sum("size").alias("bytes"))


@query(
    "schema_cast",
    _with(V.STRICT_SQL, "SELECT project_name, file_path, tokens, size, sha256, '00000' AS shard_id FROM v_strict"),
)
def schema_cast(spark, sf):
    other = V.tree_index(spark, sf).select(
        "sha256",
        F.col("size").cast("int").alias("size"),
        F.col("tokens").cast("string").alias("tokens"),
        "file_path",
        "project_name",
        F.lit("00000").alias("shard_id"),
    )
    return extract.conform(other)


@query(
    "canonical_order",
    f"WITH {V.INDEX_SQL} SELECT project_name, file_path, size FROM v_index ORDER BY project_name, file_path",
)
def canonical_order(spark, sf):
    return ordering.canonical_order(V.document_index(spark, sf).select("project_name", "file_path", "size"))


@query(
    "batch_ids",
    f"""WITH {V.INDEX_SQL}, v_n AS (
      SELECT project_name, file_path, row_number() OVER (ORDER BY project_name, file_path) AS row_number FROM v_index)
    SELECT project_name, file_path, row_number, CAST((row_number - 1) // 64 AS BIGINT) AS batch_id FROM v_n""",
)
def batch_ids(spark, sf):
    index = V.document_index(spark, sf).select("project_name", "file_path")
    return ordering.batch_ids(index, ["project_name", "file_path"], 64)


@query(
    "running_totals",
    f"""WITH {V.INDEX_SQL} SELECT project_name, file_path,
      CAST(sum(tokens) OVER w AS BIGINT) AS tokens_so_far, CAST(sum(size) OVER w AS BIGINT) AS bytes_so_far,
      count(*) OVER w AS files_so_far
    FROM v_index WINDOW w AS (ORDER BY project_name, file_path)""",
)
def running_totals(spark, sf):
    index = staging.stage(V.document_index(spark, sf).select("project_name", "file_path", "tokens", "size"), "index")
    sums = {"tokens_so_far": "tokens", "bytes_so_far": "size", "files_so_far": None}
    return ordering.running_sums(index, ["project_name", "file_path"], sums).drop("tokens", "size")


@query(
    "flat_names",
    r"""WITH v_mod AS (
      SELECT source AS project_name, lang || '/' || CAST(floor(doc_id / 20.0) AS BIGINT) || '/mod' || (n_chars % 7) || '.py'
        AS file_path, 'mod' || (n_chars % 7) AS stem FROM documents),
    v_rank AS (SELECT *, row_number() OVER (PARTITION BY project_name, stem ORDER BY file_path) AS rn FROM v_mod)
    SELECT project_name, file_path,
      CASE rn WHEN 1 THEN stem || '.py' ELSE stem || '_' || substr(sha256(file_path), 1, 16) || '.py' END AS flat_name
    FROM v_rank""",
)
def flat_names(spark, sf):
    block = F.floor(F.col("doc_id") / F.lit(20.0)).cast("long").cast("string")
    path = F.concat_ws("/", "lang", block, F.concat(F.lit("mod"), (F.col("n_chars") % 7).cast("string"), F.lit(".py")))
    files = V.table(spark, sf, "documents").select(F.col("source").alias("project_name"), path.alias("file_path"))
    return extract.flat_names(files)


_PLANNED_SQL = r""", v_planned AS (
  SELECT regexp_replace(dir_name, '_', '/') AS project_name, 'src/' || lang || '/f' || doc_id || '.py' AS file_path FROM v_kind
)"""
_PRESENT_SQL = """(SELECT project_name, file_path FROM v_tree WHERE dir_name NOT LIKE '.%')"""


def _planned(spark, sf):
    files = V.tree_table(spark, sf).join(
        V.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id"
    )
    path = F.concat(F.lit("src/"), "lang", F.lit("/f"), F.col("doc_id").cast("string"), F.lit(".py"))
    return files.select(paths.dir_to_project(F.col("dir_name")).alias("project_name"), path.alias("file_path"))


@query(
    "existing_files",
    _with(V.TREE_SQL + _PLANNED_SQL, f"SELECT * FROM v_planned WHERE (project_name, file_path) IN {_PRESENT_SQL}"),
)
def existing_files(spark, sf):
    return extract.existing_files(_planned(spark, sf), tree.scan_tree(spark, V.tree_folder(spark, sf)))


@query(
    "missing_files",
    _with(V.TREE_SQL + _PLANNED_SQL, f"SELECT * FROM v_planned WHERE (project_name, file_path) NOT IN {_PRESENT_SQL}"),
)
def missing_files(spark, sf):
    return extract.missing_files(_planned(spark, sf), tree.scan_tree(spark, V.tree_folder(spark, sf)))


# --- roll-ups -------------------------------------------------------------------------

_ROLLUP_SQL = """SELECT project_name, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS files_processed
FROM {0} GROUP BY project_name"""


@query("project_rollup", _with(V.STRICT_SQL, _ROLLUP_SQL.format("v_strict")))
def project_rollup(spark, sf):
    return rollup.project_rollup(V.tree_index(spark, sf))


@query(
    "corpus_totals",
    f"""WITH {V.INDEX_SQL} SELECT count(*) AS total_files, CAST(sum(tokens) AS BIGINT) AS total_tokens,
      CAST(sum(size) AS BIGINT) AS total_bytes, count(DISTINCT project_name) AS total_repos,
      CAST(sum(size) AS BIGINT) / 1024.0::DOUBLE / 1024.0::DOUBLE / 1024.0::DOUBLE AS total_gib
    FROM v_index""",
)
def corpus_totals(spark, sf):
    return rollup.corpus_totals(V.document_index(spark, sf))


@query(
    "token_counter",
    _with(V.COUNTED_SQL, "SELECT project_name, tokens, files_processed FROM v_counted"),
)
def token_counter(spark, sf):
    files = V.tree_table(spark, sf)
    return repo_stats.token_counter(files, files.select("dir_name").distinct())


@query(
    "pending_repos",
    _with(
        V.TREE_SQL,
        """SELECT DISTINCT project_name FROM v_tree WHERE dir_name NOT LIKE '.%' AND project_name NOT IN
          (SELECT t.project_name FROM v_tree t JOIN labels l USING (doc_id) WHERE l.toxic = 1)""",
    ),
)
def pending_repos(spark, sf):
    from corpusmill.operators.discovery import pending

    files = V.tree_table(spark, sf).select("doc_id", paths.dir_to_project(F.col("dir_name")).alias("project_name"))
    flagged = V.table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    done = files.join(flagged, "doc_id").select("project_name").distinct()
    return pending(state.cloned_set(spark, V.tree_folder(spark, sf)).toDF("project_name"), done, "project_name")


@query(
    "incremental_totals",
    f"WITH {V.INDEX_SQL} " + _ROLLUP_SQL.format("v_index"),
)
def incremental_totals(spark, sf):
    documents = V.table(spark, sf, "documents").select(
        F.col("source").alias("project_name"),
        F.col("doc_id").cast("string").alias("file_path"),
        tokens.count_tokens(F.col("text")).alias("tokens"),
        (F.col("lang") == "en").alias("earlier"),
    )
    stored = rollup.project_rollup(documents.filter("earlier"))
    return rollup.add_rollups(stored, rollup.project_rollup(documents.filter("not earlier")))


@query(
    "reconcile_totals",
    _with(
        V.STRICT_SQL + "," + V.COUNTED_SQL.replace(V.TREE_SQL + ",", ""),
        """, v_sides AS (
          SELECT CAST(e.tokens AS BIGINT) AS expected_tokens, CAST(a.tokens AS BIGINT) AS actual_tokens,
            CAST(e.files AS BIGINT) AS expected_files, CAST(a.files AS BIGINT) AS actual_files
          FROM (SELECT sum(tokens) AS tokens, sum(files_processed) AS files FROM v_counted) e,
            (SELECT sum(tokens) AS tokens, count(*) AS files FROM v_strict) a)
        SELECT *, actual_tokens - expected_tokens AS tokens_diff, actual_tokens = expected_tokens AS tokens_match,
          actual_files - expected_files AS files_diff, actual_files = expected_files AS files_match,
          actual_files < expected_files AS lower_is_expected FROM v_sides""",
    ),
)
def reconcile_totals(spark, sf):
    actual = rollup.corpus_totals(V.tree_index(spark, sf))
    return rollup.reconcile(actual, rollup.summary_totals(token_counter(spark, sf)))


@query(
    "reconcile_projects",
    _with(
        V.STRICT_SQL + "," + V.COUNTED_SQL.replace(V.TREE_SQL + ",", ""),
        """, v_actual AS (SELECT project_name, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS files FROM v_strict
            WHERE project_name NOT LIKE '%1' GROUP BY project_name),
          v_expected AS (SELECT project_name, CAST(tokens AS BIGINT) AS tokens, CAST(files_processed AS BIGINT) AS files
            FROM v_counted WHERE project_name NOT LIKE '%2')
        SELECT project_name, CASE WHEN a.files IS NOT NULL AND e.files IS NOT NULL THEN 'both' WHEN a.files IS NOT NULL
            THEN 'actual' ELSE 'expected' END AS side,
          e.tokens AS expected_tokens, a.tokens AS actual_tokens, coalesce(a.tokens, 0) - coalesce(e.tokens, 0) AS tokens_diff,
          coalesce(a.tokens = e.tokens, false) AS tokens_match, e.files AS expected_files, a.files AS actual_files,
          coalesce(a.files, 0) - coalesce(e.files, 0) AS files_diff, coalesce(a.files = e.files, false) AS files_match
        FROM v_actual a FULL JOIN v_expected e USING (project_name)""",
    ),
)
def reconcile_projects(spark, sf):
    """Strict totals against lossy counts, each without some projects of the other."""
    actual = rollup.project_rollup(V.tree_index(spark, sf)).filter("project_name NOT LIKE '%1'")
    expected = token_counter(spark, sf).filter("project_name NOT LIKE '%2'")
    return rollup.reconcile_projects(actual, expected)


@query(
    "summary_json",
    f"WITH {V.INDEX_SQL}, v_rollup AS (" + _ROLLUP_SQL.format("v_index") + """),
    v_total AS (SELECT CAST(sum(tokens) AS BIGINT) AS t, count(*) AS r, CAST(sum(files_processed) AS BIGINT) AS f FROM v_rollup)
    SELECT 0 AS part, '' AS project_name,
      '{"total_tokens":' || t || ',"total_repos":' || r || ',"total_files":' || f || ',"repos":{' AS line FROM v_total
    UNION ALL
    SELECT 1, project_name, CASE WHEN project_name = (SELECT min(project_name) FROM v_rollup) THEN '' ELSE ',' END
      || '"' || project_name || '":{"tokens":' || tokens || ',"files_processed":' || files_processed || '}' FROM v_rollup
    UNION ALL SELECT 2, '', '}}' FROM v_total""",
)
def summary_json(spark, sf):
    return rollup.summary_lines(rollup.project_rollup(V.document_index(spark, sf)))


@query("token_counts_read", f"WITH {V.INDEX_SQL} " + _ROLLUP_SQL.format("v_index"))
def token_counts_read(spark, sf):
    """One summary document per file of the index, read as the state of many earlier runs."""
    one = F.struct(F.col("tokens").alias("tokens"), F.lit(1).cast("long").alias("files_processed"))
    document = F.to_json(
        F.struct(
            F.col("tokens").alias("total_tokens"),
            F.lit(1).alias("total_repos"),
            F.lit(1).alias("total_files"),
            F.create_map("project_name", one).alias("repos"),
        )
    )
    path = staging.new_path(spark, "token-counts")
    V.document_index(spark, sf).select(document.alias("value")).write.text(path)
    read = state.read_token_counts(spark, path, lines=True)
    return read.groupBy("project_name").agg(
        F.sum("tokens").alias("tokens"), F.sum("files_processed").alias("files_processed")
    )


@query(
    "summary_documents",
    f"WITH {V.INDEX_SQL} SELECT file_path AS project_name, tokens, CAST(1 AS BIGINT) AS files_processed FROM v_index",
)
def summary_documents(spark, sf):
    """Summaries of a hundred documents each, every one on a single line, read in splits of 2 KiB."""
    one = F.struct(F.col("tokens").alias("tokens"), F.lit(1).cast("long").alias("files_processed"))
    entries = F.map_from_entries(F.collect_list(F.struct("file_path", one)))
    grouped = V.document_index(spark, sf).groupBy(F.expr("CAST(file_path AS BIGINT) div 100").alias("block")).agg(
        F.sum("tokens").alias("total_tokens"), F.count("*").alias("total_files"), entries.alias("repos")
    )
    document = F.to_json(F.struct("total_tokens", F.col("total_files").alias("total_repos"), "total_files", "repos"))
    path = staging.new_path(spark, "summaries")
    # a file takes its time whatever its size, so all cores write them
    dealt = grouped.select("block", document.alias("value")).repartition(spark.sparkContext.defaultParallelism, "block")
    dealt.write.partitionBy("block").text(path)
    return state.read_summary(spark, path, split_bytes=2048)[1]


# --- repository statistics ------------------------------------------------------------

def _sql_list(values: list[str]) -> str:
    return "(" + ",".join(f"'{v}'" for v in values) + ")"


_CODE, _TEXT, _KEEP = map(_sql_list, (C.CODE_EXTENSIONS, C.TEXT_EXTENSIONS, C.ALWAYS_KEEP_NAMES))


def _typed_sql(file_cap: int, txt_cap: int, json_cap: int) -> str:
    return (
        V.TREE_SQL
        + rf""",
v_ext AS (SELECT *, lower(regexp_extract(name, '^.+(\.[^.]+)$', 1)) AS ext FROM v_tree),
v_class AS (
  SELECT *, CASE WHEN ext = '' THEN 'none' WHEN ext IN {_CODE} THEN 'code' WHEN ext IN {_TEXT} THEN 'text'
    ELSE 'other' END AS class,
    NOT ((ext = '.txt' AND size > {txt_cap}) OR size > {file_cap}) AS eligible
  FROM v_ext
),
v_action AS (
  SELECT *, CASE WHEN list_contains(string_split(file_path, '/'), '.git') THEN 'ignore'
    WHEN upper(name) IN {_KEEP} OR name IN {_KEEP} THEN 'keep'
    WHEN ext = '.txt' AND size > {txt_cap} THEN 'drop'
    WHEN ext = '.json' AND size > {json_cap} THEN 'drop'
    WHEN class <> 'other' THEN 'keep' ELSE 'drop' END AS action
  FROM v_class
)
"""
    )


_CAPPED_SQL = _typed_sql(FILE_CAP, TXT_CAP, JSON_CAP)
_TYPED_SQL = _typed_sql(C.MAX_FILE_SIZE, C.TXT_SIZE_CAP, C.JSON_SIZE_CAP)
_CAPS = {"txt_cap": TXT_CAP, "json_cap": JSON_CAP}


@query("purge_plan", _with(_CAPPED_SQL, "SELECT dir_name, file_path, size, action FROM v_action"))
def purge_plan(spark, sf):
    return repo_stats.purge_plan(V.tree_table(spark, sf).select(*FILE), **_CAPS)


@query(
    "purge_stats",
    _with(
        _TYPED_SQL,
        """SELECT dir_name, count(*) FILTER (action = 'drop') AS files_deleted,
          CAST(coalesce(sum(size) FILTER (action = 'drop'), 0) AS BIGINT) AS bytes_freed FROM v_action GROUP BY dir_name""",
    ),
)
def purge_stats(spark, sf):
    return repo_stats.purge_stats(repo_stats.purge_plan(V.tree_table(spark, sf).select(*FILE)))


@query("token_eligible", _with(_CAPPED_SQL, "SELECT dir_name, file_path, ext, eligible FROM v_class"))
def token_eligible(spark, sf):
    ext = paths.suffix(paths.basename(F.col("file_path")))
    eligible = repo_stats.token_eligible(F.col("ext"), F.col("size"), txt_cap=TXT_CAP, size_cap=FILE_CAP)
    files = V.tree_table(spark, sf).withColumn("ext", ext)
    return files.select("dir_name", "file_path", "ext", eligible.alias("eligible"))


@query("ext_class", _with(_TYPED_SQL, "SELECT dir_name, file_path, ext, class FROM v_class"))
def ext_class(spark, sf):
    files = V.tree_table(spark, sf).withColumn("ext", paths.suffix(paths.basename(F.col("file_path"))))
    return files.select("dir_name", "file_path", "ext", repo_stats.extension_class(F.col("ext")).alias("class"))


STATS_SQL = (
    _TYPED_SQL
    + f""",
v_tokens AS (
  SELECT *, action = 'drop' AS dropped,
    CASE WHEN action <> 'drop' AND class IN ('code', 'text') AND eligible AND length(lossy) <= {C.MAX_CONTENT_CHARS}
      THEN {V.TOKENS_SQL.format("lossy")} ELSE 0 END AS tokens
  FROM v_action
),
v_stats AS (
  SELECT dir_name, count(*) FILTER (NOT dropped) AS total_files,
    count(*) FILTER (tokens > 0 AND class = 'code') AS python_files,
    CAST(sum(tokens) AS BIGINT) AS tokens,
    CAST(coalesce(sum(size) FILTER (NOT dropped), 0) AS BIGINT) AS size_bytes,
    count(*) FILTER (dropped) AS files_deleted,
    CAST(coalesce(sum(size) FILTER (dropped), 0) AS BIGINT) AS bytes_freed,
    count(*) FILTER (tokens > 0) AS files_processed
  FROM v_tokens GROUP BY dir_name
)
"""
)


@query("repo_stats", _with(STATS_SQL, "SELECT * FROM v_stats"))
def repo_stats_query(spark, sf):
    return repo_stats.repo_stats(V.tree_table(spark, sf))


def _repo_db(spark, sf):
    stats = repo_stats_query(spark, sf)
    fields = [c for c in stats.columns if c != "dir_name"]
    return stats.select(
        paths.dir_to_project(F.col("dir_name")).alias("full_name"),
        F.lit("https://example.org/").alias("url"),
        F.col("dir_name").alias("path"),
        F.struct(*fields).alias("stats"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("cloned_at"),
        F.lit(1).cast("long").alias("stars"),
        F.lit(0).cast("long").alias("forks"),
        F.lit(0).cast("long").alias("size"),
        F.lit(None).cast("string").alias("note"),
    )


@query(
    "recalc_totals",
    _with(
        STATS_SQL,
        """SELECT CAST(sum(tokens) AS BIGINT) AS total_tokens, CAST(sum(python_files) AS BIGINT) AS python_files,
          count(*) AS repos, CAST(max(tokens) AS BIGINT) AS stored_tokens, sum(tokens) <> max(tokens) AS drifted
        FROM v_stats""",
    ),
)
def recalc_totals(spark, sf):
    return repo_stats.recalc_totals(_repo_db(spark, sf), F.col("stats.tokens"))


@query(
    "backfill_repos",
    _with(
        STATS_SQL,
        """, v_db AS (SELECT DISTINCT t.dir_name FROM v_tree t JOIN labels l USING (doc_id) WHERE l.toxic = 1)
        SELECT regexp_replace(s.dir_name, '_', '/') AS full_name,
          CASE WHEN d.dir_name IS NULL THEN 'unknown' ELSE 'https://example.org/' END AS url,
          CASE WHEN d.dir_name IS NULL THEN '/data/' || s.dir_name ELSE s.dir_name END AS path,
          s.tokens, s.total_files, CAST(CASE WHEN d.dir_name IS NULL THEN 0 ELSE 1 END AS BIGINT) AS stars,
          CASE WHEN d.dir_name IS NULL THEN 'Processed from existing directory' END AS note
        FROM v_stats s LEFT JOIN v_db d ON d.dir_name = s.dir_name""",
    ),
)
def backfill_repos(spark, sf):
    flagged = V.table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    known = V.tree_table(spark, sf).join(flagged, "doc_id").select(F.col("dir_name").alias("path")).distinct()
    db = _repo_db(spark, sf).join(known, "path", "left_semi")
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    whole = repo_stats.backfill_repos(repo_stats_query(spark, sf), db, root="/data", at=at)
    return whole.select("full_name", "url", "path", "stats.tokens", "stats.total_files", "stars", "note")


# --- scalar functions -----------------------------------------------------------------


@query(
    "name_roundtrip",
    r"""WITH v_dirs AS (SELECT DISTINCT source || '_' || lang || '_x' AS dir_name FROM documents)
    SELECT dir_name, regexp_replace(dir_name, '_', '/') AS project_name,
      regexp_replace(regexp_replace(dir_name, '_', '/'), '/', '_') AS back,
      replace(regexp_replace(dir_name, '_', '/') || '/y', '/', '_') AS all_slashes FROM v_dirs""",
)
def name_roundtrip(spark, sf):
    name = F.concat("source", F.lit("_"), "lang", F.lit("_x"))
    dirs = V.table(spark, sf, "documents").select(name.alias("dir_name")).distinct()
    project = paths.dir_to_project(F.col("dir_name"))
    return dirs.select(
        "dir_name",
        project.alias("project_name"),
        paths.project_to_dir(project).alias("back"),
        paths.full_name_to_dir(F.concat(project, F.lit("/y"))).alias("all_slashes"),
    )


@query(
    "path_parts",
    _with(
        V.TREE_SQL,
        r"""SELECT file_path, name, parent, '/data/' || regexp_replace(project_name, '/', '_') || '/' || file_path AS location,
          project_name || '/' || file_path AS member FROM v_tree""",
    ),
)
def path_parts(spark, sf):
    path, project = F.col("file_path"), paths.dir_to_project(F.col("dir_name"))
    return V.tree_table(spark, sf).select(
        "file_path",
        paths.basename(path).alias("name"),
        paths.parent(path).alias("parent"),
        paths.source_path(project, path, "/data").alias("location"),
        paths.member_name(project, path).alias("member"),
    )


@query(
    "path_suffix",
    r"""WITH v_names AS (
      SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'f' || doc_id || '.tar.gz' WHEN 1 THEN '.env' || doc_id
        WHEN 2 THEN 'Makefile' || doc_id WHEN 3 THEN 'a' || doc_id || '.' WHEN 4 THEN '..x' || doc_id
        WHEN 5 THEN 'X' || doc_id || '.PY' WHEN 6 THEN lang || '.env' ELSE source || '.v' || doc_id || '.Py' END AS name
      FROM documents)
    SELECT doc_id, name, lower(regexp_extract(name, '^.+(\.[^.]+)$', 1)) AS suffix,
      substr(name, 1, length(name) - length(regexp_extract(name, '^.+(\.[^.]+)$', 1))) AS stem FROM v_names""",
)
def path_suffix(spark, sf):
    doc = F.col("doc_id").cast("string")
    shapes = [
        F.concat(F.lit("f"), doc, F.lit(".tar.gz")),
        F.concat(F.lit(".env"), doc),
        F.concat(F.lit("Makefile"), doc),
        F.concat(F.lit("a"), doc, F.lit(".")),
        F.concat(F.lit("..x"), doc),
        F.concat(F.lit("X"), doc, F.lit(".PY")),
        F.concat("lang", F.lit(".env")),
        F.concat("source", F.lit(".v"), doc, F.lit(".Py")),
    ]
    name = F.element_at(F.array(*shapes), (F.col("doc_id") % 8 + 1).cast("int"))
    names = V.table(spark, sf, "documents").select("doc_id", name.alias("name"))
    return names.select(
        "doc_id", "name", paths.suffix(F.col("name")).alias("suffix"), paths.stem(F.col("name")).alias("stem")
    )


@query("sha256", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256(spark, sf):
    return V.table(spark, sf, "documents").select(
        "doc_id", text.sha256_hex(F.col("text").cast("binary")).alias("sha256")
    )


@query(
    "token_count",
    f"SELECT doc_id, CAST({V.TOKENS_SQL.format('text')} AS BIGINT) AS tokens FROM documents",
)
def token_count(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", tokens.count_tokens(F.col("text")).alias("tokens"))


#: A byte-level vocabulary as ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query("bpe_token_count")
def bpe_token_count(spark, sf, vocabulary: str = VOCABULARY):
    """Tokens of every whole text by a BPE vocabulary on storage."""
    counted = tokens.count_tokens(F.col("text"), tokens.BpeFile(vocabulary))
    return V.table(spark, sf, "documents").select("doc_id", counted.alias("tokens"))


@query(
    "shard_names",
    """SELECT o_orderkey, printf('%05d', o_orderkey) AS shard_id, 'shard_' || printf('%05d', o_orderkey) || '.tar.zst' AS archive,
      'shard_' || printf('%05d', o_orderkey) || '_metadata.parquet' AS metadata FROM orders""",
)
def shard_names(spark, sf):
    number = F.col("o_orderkey")
    return V.table(spark, sf, "orders").select(
        number,
        units.shard_label(number).alias("shard_id"),
        units.shard_file(number).alias("archive"),
        units.shard_metadata_file(number).alias("metadata"),
    )


@query(
    "size_units",
    """SELECT doc_id, strlen(text) / 1024.0::DOUBLE / 1024.0::DOUBLE AS mib,
      strlen(text) / 1024.0::DOUBLE / 1024.0::DOUBLE / 1024.0::DOUBLE AS gib,
      strlen(text) / 33333.0::DOUBLE * 100.0::DOUBLE AS pct FROM documents""",
)
def size_units(spark, sf):
    size = F.octet_length("text")
    return V.table(spark, sf, "documents").select(
        "doc_id",
        units.mib(size).alias("mib"),
        units.gib(size).alias("gib"),
        units.percent(size, F.lit(33333.0)).alias("pct"),
    )


@query(
    "elapsed",
    """SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000.0::DOUBLE AS seconds FROM events""",
)
def elapsed(spark, sf):
    start = F.lit("2024-01-01T00:00:00").cast("timestamp_ntz")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    parsed = F.to_timestamp_ntz(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return V.table(spark, sf, "events").select("event_id", units.elapsed_seconds(start, parsed).alias("seconds"))


_RATE_SQL = """v_rates AS (
  SELECT event_id, CAST(event_id * 1000 AS BIGINT) AS done,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-02 00:00:00')) / 1000000.0::DOUBLE AS seconds FROM events)"""


def _rates(spark, sf):
    start = F.lit("2024-01-02T00:00:00").cast("timestamp_ntz")
    return V.table(spark, sf, "events").select(
        "event_id",
        (F.col("event_id") * 1000).alias("done"),
        units.elapsed_seconds(start, F.col("ts")).alias("seconds"),
    )


@query(
    "throughput",
    f"""WITH {_RATE_SQL} SELECT event_id, CASE WHEN seconds > 0 THEN done / seconds ELSE 0.0::DOUBLE END AS tokens_per_sec,
      CASE WHEN seconds > 0 THEN event_id / seconds * 60.0::DOUBLE ELSE 0.0::DOUBLE END AS repos_per_min FROM v_rates""",
)
def throughput(spark, sf):
    return _rates(spark, sf).select(
        "event_id",
        units.per_second(F.col("done"), F.col("seconds")).alias("tokens_per_sec"),
        units.per_minute(F.col("event_id"), F.col("seconds")).alias("repos_per_min"),
    )


@query(
    "eta_text",
    f"""WITH {_RATE_SQL}, v_rate AS (
      SELECT event_id, done, CASE WHEN seconds > 0 THEN done / seconds ELSE 0.0::DOUBLE END AS rate FROM v_rates),
    v_left AS (SELECT event_id, CASE WHEN rate > 0 THEN (30000000 - done) / rate END AS s FROM v_rate)
    SELECT event_id, CASE WHEN s / 86400 >= 1 THEN printf('%.1f days', s / 86400)
      WHEN (s - floor(s / 86400) * 86400) / 3600 >= 1 THEN printf('%.1f hours', (s - floor(s / 86400) * 86400) / 3600)
      WHEN s IS NOT NULL THEN printf('%.1f minutes', s / 60) END AS eta FROM v_left""",
)
def eta_text(spark, sf):
    rate = units.per_second(F.col("done"), F.col("seconds"))
    left = units.eta_seconds(F.col("done"), F.lit(30_000_000), rate)
    return _rates(spark, sf).select("event_id", units.eta_text(left).alias("eta"))
