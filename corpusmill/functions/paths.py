"""Project names and file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SUFFIX = r"(?s)^.+(\.[^.]+)$"
_STEM = r"(?s)^(.+)\.[^.]+$"


def dir_to_project(directory: Column) -> Column:
    """``owner_repo_x`` → ``owner/repo_x``: only the first underscore is the separator."""
    return F.regexp_replace(directory, r"(?s)^([^_]*)_", "$1/")


def project_to_dir(project: Column) -> Column:
    """Inverse of :func:`dir_to_project`."""
    return F.regexp_replace(project, r"(?s)^([^/]*)/", "$1_")


def full_name_to_dir(full_name: Column) -> Column:
    """Directory a clone is put in: every slash becomes an underscore."""
    return F.replace(full_name, F.lit("/"), F.lit("_"))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """Directory part with its trailing slash, or the empty string."""
    return F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)


def suffix(name: Column) -> Column:
    """Lower-cased last suffix; dotfiles and names ending in a dot have none."""
    return F.lower(F.regexp_extract(name, _SUFFIX, 1))


def raw_suffix(name: Column) -> Column:
    return F.regexp_extract(name, _SUFFIX, 1)


def stem(name: Column) -> Column:
    return F.when(name.rlike(_STEM), F.regexp_extract(name, _STEM, 1)).otherwise(name)


def source_path(project: Column, file_path: Column, root: str) -> Column:
    """Where an indexed file lies on storage."""
    return F.concat(F.lit(root.rstrip("/") + "/"), project_to_dir(project), F.lit("/"), file_path)


def member_name(project: Column, file_path: Column) -> Column:
    """Name of a file inside a shard archive."""
    return F.concat(project, F.lit("/"), file_path)


def under_git_like(dir_name: Column, file_path: Column) -> Column:
    """True if ``.git`` occurs anywhere in the directory part, counted from the project down."""
    return F.contains(F.concat(dir_name, F.lit("/"), parent(file_path)), F.lit(".git"))


def under_git(file_path: Column) -> Column:
    """True if a path component is exactly ``.git``."""
    return F.array_contains(F.split(file_path, "/", -1), ".git")


def is_hidden(name: Column) -> Column:
    return F.startswith(name, F.lit("."))
