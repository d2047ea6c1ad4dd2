"""Paths, digests, identifiers and URIs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posefold import contracts as C

# Fixed value: where an episode file must sit inside the dataset.
EPISODE_PATH = r"^data/val/(?!\.{1,2}/)[^/]+/episode_[^/]*/episode\.fo\.mcap$"


def stripped(column: str | Column) -> Column:
    """Text without white space of any kind at its ends."""
    text = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(column: str | Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(stripped(column), F.lit(""))


def is_blank_value(column: str) -> Column:
    """True for a supplied value that holds only blanks: an error, unlike an absent value."""
    return F.coalesce(stripped(column) == "", F.lit(False))


def hex_digest(column: str, digits: int) -> Column:
    """Lower-case digest without a ``sha256:`` prefix; null unless exactly ``digits`` hex digits."""
    text = F.col(column)
    if digits == 64:
        text = F.regexp_replace(text, r"^sha256:", "")
    text = F.lower(text)
    return F.when(text.rlike(f"^[0-9a-f]{{{digits}}}$"), text)


def is_episode_path(column: str) -> Column:
    """The path contract ``data/val/<task>/episode_<id>/episode.fo.mcap``."""
    return F.coalesce(F.col(column).rlike(EPISODE_PATH), F.lit(False))


def path_part(column: str, index: int) -> Column:
    """The ``index``-th part (1-based, negative from the end) of a slash-separated path."""
    return F.try_element_at(F.split(F.col(column), "/"), F.lit(index))


def task_from_path(column: str) -> Column:
    """Task named by a path: the folder above an ``episode_*`` folder, else the parent folder."""
    parent = path_part(column, -2)
    return F.when(F.startswith(parent, F.lit("episode_")), path_part(column, -3)).otherwise(parent)


def episode_from_path(column: str) -> Column:
    """Episode named by a path: an ``episode_*`` parent folder, else the file name without suffix."""
    parent = path_part(column, -2)
    stem = F.regexp_replace(path_part(column, -1), r"(\.fo)?\.mcap$", "")
    return F.when(F.startswith(parent, F.lit("episode_")), parent).otherwise(stem)


def episode_from_session(column: str) -> Column:
    """Episode id from a session uuid; the ``episode_`` prefix is added when absent."""
    uuid = blank_to_null(column)
    return F.when(F.startswith(uuid, F.lit("episode_")), uuid).otherwise(
        F.concat(F.lit("episode_"), uuid)
    )


def pinned_uri(dataset_id: str, revision: str, path: str, scheme: str = "hf") -> Column:
    """Canonical URI of a file at one dataset revision."""
    return F.concat(F.lit(pinned_prefix(dataset_id, revision, scheme)), F.col(path))


def pinned_prefix(dataset_id: str, revision: str, scheme: str = "hf") -> str:
    return f"{scheme}://datasets/{dataset_id}@{revision}/"


def resolve_url(base: str, dataset_id: str, revision: str, path: str) -> Column:
    """Download URL of the same file."""
    prefix = f"{base.rstrip('/')}/datasets/{dataset_id}/resolve/{revision}/"
    return F.concat(F.lit(prefix), F.col(path))


def uri_names_episode(uri: str, task: str, episode: str) -> Column:
    """True when task and episode (with or without ``episode_``) are path segments of the URI."""
    decoded = F.regexp_replace(F.col(uri), r"^[^:/?#]+://[^/?#]*|[?#].*$", "")
    parts = F.split(F.try_url_decode(decoded), "/")
    named = F.array_contains(parts, F.col(episode)) | F.array_contains(
        parts, F.concat(F.lit("episode_"), F.col(episode))
    )
    filled = ~(is_blank_value(uri) | is_blank_value(task) | is_blank_value(episode))
    return F.coalesce(filled & F.array_contains(parts, F.col(task)) & named, F.lit(False))


def sha256_of_text(column: Column) -> Column:
    return F.sha2(column, 256)


def git_blob_oid(content: str = "content") -> Column:
    """Object id git gives to these bytes (a binary column): SHA-1 over a ``blob <size>NUL`` header and the
    content."""
    return F.expr(
        f"sha1(concat(encode(concat('blob ', octet_length({content}), char(0)), 'utf-8'), {content}))"
    )


def cohort_coordinate(column: str | Column, decimals: int = C.COHORT_DECIMALS) -> Column:
    """Coordinate rounded half-even for grouping; a negative zero becomes zero."""
    value = F.bround(column, decimals)
    return F.when(value == 0, F.lit(0.0)).otherwise(value)
