"""Classification and filter expressions over paths, sizes and media types.

Everything here is a Column built from built-in functions, so it runs inside code generation and
filters on plain columns reach the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions import tables as t


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a literal table, null where the key is missing."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def file_extension(path: Column) -> Column:
    """Lower-case text after the last dot of the whole path, '' without a dot."""
    return F.when(F.contains(path, F.lit(".")), F.lower(F.substring_index(path, ".", -1))).otherwise(F.lit(""))


def local_extension(name: Column) -> Column:
    """Lower-case suffix of a file name; a leading or trailing dot makes no suffix."""
    return F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def content_type_by_ext(ext: Column) -> Column:
    code = F.when(ext.isin(t.CODE_EXTENSIONS), F.lit("code"))
    return F.coalesce(lookup(t.CONTENT_TYPES, ext), code, F.lit("unknown"))


def content_type_office(ext: Column, family: str) -> Column:
    table = {"dropbox": t.DROPBOX_TYPES, "onedrive": t.ONEDRIVE_TYPES}[family]
    return F.coalesce(lookup(table, ext), F.lit("unknown"))


def content_type_by_mime(mime: Column) -> Column:
    by_prefix = (
        F.when(mime.startswith("text/x-") | mime.startswith("application/x-"), F.lit("code"))
        .when(mime.startswith("text/"), F.lit("text"))
        .otherwise(F.lit("unknown"))
    )
    return F.coalesce(lookup(t.MIME_TYPES, mime), by_prefix)


def language_by_ext(ext: Column, family: str = "git") -> Column:
    table = {"git": t.LANGUAGES, "bitbucket": t.BITBUCKET_LANGUAGES, "local": t.LOCAL_LANGUAGES}[family]
    return lookup(table, ext)


def export_mime(mime: Column) -> Column:
    return F.coalesce(lookup(t.EXPORT_MIMES, mime), mime)


def source_kind(connector_type: Column) -> Column:
    return F.coalesce(lookup(t.SOURCE_KINDS, connector_type), F.lit("other"))


def chunk_strategy(connector_type: Column, language: Column) -> Column:
    known = language.isNotNull() & (language != "")
    return (
        F.when(connector_type.isin(t.GIT_TYPES), F.when(known, F.lit("code_ast")).otherwise(F.lit("code_block")))
        .when(connector_type.isin(t.WIKI_TYPES), F.lit("doc_heading"))
        .when(connector_type == "slack", F.lit("chat_sliding_window"))
    )


# ---- filters: true keeps the row -------------------------------------------------------------


def not_binary_repo(ext: Column) -> Column:
    return ~ext.isin(t.BINARY_REPO)


def not_binary_office(ext: Column) -> Column:
    return ~ext.isin(t.BINARY_OFFICE)


def _any(conditions: Iterable[Column]) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def not_skipped_mime(mime: Column) -> Column:
    return ~_any(mime.startswith(p) for p in t.SKIP_MIMES)


def not_hidden(relative_path: Column) -> Column:
    return ~F.rlike(relative_path, F.lit(r"(^|/)\."))


def within_size(size: Column | None, max_mb: float | None) -> Column:
    """A missing or zero limit, and a missing or zero size, let everything pass."""
    if not max_mb or size is None:
        return F.lit(True)
    return F.coalesce(size, F.lit(0)) <= int(max_mb * 1024 * 1024)


def _has_extension(ext: Column, wanted: list[str] | None) -> Column:
    if not wanted:
        return F.lit(True)
    return ext.isin([w.lower().lstrip(".") for w in wanted])


def sync_filter_repo(
    path: Column, size: Column | None, include: list[str] | None = None, exclude: list[str] | None = None,
    max_mb: float | None = None,
) -> Column:
    """Size limit, then case-sensitive substring excludes, then the extension list."""
    excluded = _any(F.contains(path, F.lit(x)) for x in exclude or [])
    return within_size(size, max_mb) & ~excluded & _has_extension(file_extension(path), include)


def sync_filter_folder(
    path: Column, size: Column | None, include: list[str] | None = None, exclude: list[str] | None = None,
    max_mb: float | None = None,
) -> Column:
    """The same with excludes that ignore case."""
    excluded = _any(F.contains(F.lower(path), F.lit(x.lower())) for x in exclude or [])
    return within_size(size, max_mb) & ~excluded & _has_extension(file_extension(path), include)


def sync_filter_mime(
    mime: Column, size: Column | None, include: list[str] | None = None, max_mb: float | None = None
) -> Column:
    kept = _any(mime.startswith(p) for p in include) if include else F.lit(True)
    return within_size(size, max_mb) & kept


def drive_predicate(
    trashed: Column, mime: Column, parents: Column, owned_by_me: Column, folder_id: str | None = None,
    include_shared: bool = True,
) -> Column:
    kept = ~trashed & (mime != t.FOLDER_MIME)
    if folder_id:
        kept = kept & F.array_contains(parents, folder_id)
    return kept if include_shared else kept & owned_by_me


def glob_regex(patterns: Iterable[str]) -> str:
    """One regular expression for a list of globs.

    ``**`` crosses directories, ``*`` and ``?`` do not. A pattern without a slash matches a file name
    at any depth; ``dir/**`` matches a directory at any depth.
    """
    parts = []
    for glob in patterns:
        body = ""
        for piece in re.split(r"(\*\*|\*|\?)", glob):
            body += {"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(piece, re.escape(piece))
        parts.append(body)
    return "(^|/)(" + "|".join(parts) + ")$"


def glob_filter(
    path: Column, size: Column | None = None, language: Column | None = None, include: list[str] | None = None,
    exclude: list[str] | None = None, include_languages: list[str] | None = None,
    exclude_languages: list[str] | None = None, max_bytes: int = 1048576,
) -> Column:
    """Default and user globs, language lists and a size limit."""
    kept = ~F.rlike(path, F.lit(glob_regex([*t.DEFAULT_EXCLUDES, *(exclude or [])])))
    if include:
        kept = kept & F.rlike(path, F.lit(glob_regex(include)))
    if size is not None:
        kept = kept & (F.coalesce(size, F.lit(0)) <= max_bytes)
    if language is not None and include_languages:
        kept = kept & F.coalesce(language.isin(include_languages), F.lit(False))
    if language is not None and exclude_languages:
        kept = kept & ~F.coalesce(language.isin(exclude_languages), F.lit(False))
    return kept


def in_domain(value: Column, domain: str) -> Column:
    """Whether an enumerated value is one of the allowed ones; null is not."""
    return F.coalesce(value.isin(t.DOMAINS[domain]), F.lit(False))


def only_files(node_type: Column) -> Column:
    return node_type.isin("blob", "commit_file", "file")
