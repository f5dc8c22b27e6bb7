"""Declared schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

_L, _S = T.LongType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LISTING = _struct(("dir_name", _S), ("file_path", _S), ("name", _S), ("size", _L))

FILE_CHUNK = _struct(
    ("project_name", _S),
    ("relative_path", _S),
    ("file_size", _L),
    ("sha256", _S),
    ("token_count", _L),
    ("absolute_path", _S),
)

INDEX = _struct(
    ("project_name", _S),
    ("file_path", _S),
    ("tokens", _L),
    ("size", _L),
    ("sha256", _S),
    ("shard_id", _S),
)

PROJECT_TOTALS = _struct(("tokens", _L), ("files_processed", _L))

TOKEN_COUNTS = _struct(
    ("total_tokens", _L),
    ("total_repos", _L),
    ("total_files", _L),
    ("repos", T.MapType(_S, PROJECT_TOTALS)),
)

HIT = _struct(("full_name", _S), ("clone_url", _S), ("stars", _L))

RAW_ITEM = _struct(
    ("id", _L),
    ("full_name", _S),
    ("clone_url", _S),
    ("stargazers_count", _L),
    ("forks_count", _L),
    ("size", _L),
)

RAW_PAGE = _struct(
    ("query", _S),
    ("sort", _S),
    ("page", T.IntegerType()),
    ("total_count", _L),
    ("items", T.ArrayType(RAW_ITEM)),
)

REPO_STATS = _struct(
    ("total_files", _L),
    ("python_files", _L),
    ("tokens", _L),
    ("size_bytes", _L),
    ("files_deleted", _L),
    ("bytes_freed", _L),
    ("files_processed", _L),
)

REPO = _struct(
    ("full_name", _S),
    ("url", _S),
    ("path", _S),
    ("stats", REPO_STATS),
    ("cloned_at", T.TimestampNTZType()),
    ("stars", _L),
    ("forks", _L),
    ("size", _L),
    ("note", _S),
)

PROGRESS = _struct(
    ("total_tokens", _L),
    ("repos_cloned", _L),
    ("repos_failed", _L),
    ("repos_skipped", _L),
    ("start_time", _S),
    ("last_update", _S),
    ("search_queries_completed", T.ArrayType(_S)),
    ("current_page", T.MapType(_S, _L)),
    ("current_min_stars", _L),
    ("threshold_expansions", _L),
    ("session_start", _S),
    ("repos_this_session", _L),
)
