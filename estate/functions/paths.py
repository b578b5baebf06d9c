"""Column expressions over paths, names and URIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.functions.rules import NO_EXTENSION, ROOT_DIRECTORY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_path(path: Column | str, url: bool = False) -> Column:
    """Forward slashes, no doubled or leading slash; a URL loses its trailing slash too.

    Nearly all paths have none of these, and a search for a fixed text tells them from the rest.
    """
    p = _col(path)
    odd = F.contains(p, F.lit("\\")) | F.contains(p, F.lit("//"))
    flat = F.when(odd, F.regexp_replace(F.replace(p, F.lit("\\"), F.lit("/")), "/+", "/")).otherwise(p)
    return F.regexp_replace(flat, "^/|/$", "") if url else F.ltrim(flat, F.lit("/"))


#: a column that holds normalised paths, where a table keeps them
PATH_KEY = "path_key"


def path_key(df: DataFrame, path: str = "path") -> Column:
    """What names a file however its path is written: the stored key of the table if it has one, so that its layout serves joins."""
    return F.col(PATH_KEY) if PATH_KEY in df.columns else normalize_path(path)


def keyed_by_path(df: DataFrame, path: str, key: str = "_key") -> DataFrame:
    """``df`` with what names its files as a column ``key`` to join on.

    It is generated, not projected: a join would take a projected one for its expression, and its sort derive that again for every two rows compared.
    """
    if PATH_KEY in df.columns:
        return df.withColumn(key, F.col(PATH_KEY))
    return df.select("*", F.explode(F.array(normalize_path(path))).alias(key))


def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def parent_dir(path: Column | str) -> Column:
    """Folder of a file, ``.`` for files at the root."""
    p = _col(path)
    above = F.left(p, F.length(p) - F.length(file_name(p)) - 1)
    return F.when(F.contains(p, F.lit("/")), above).when(p.isNotNull(), F.lit(ROOT_DIRECTORY))


def extension(name: Column | str) -> Column:
    """Lower-case suffix with its dot; empty for dot-files and trailing dots."""
    bare = F.ltrim(_col(name), F.lit("."))
    last = F.substring_index(bare, ".", -1)
    has_suffix = F.contains(bare, F.lit(".")) & (last != "")
    return F.when(has_suffix, F.lower(F.concat(F.lit("."), last))).when(bare.isNotNull(), F.lit(""))


def extension_label(name: Column | str) -> Column:
    ext = extension(name)
    return F.when(ext == "", F.lit(NO_EXTENSION)).otherwise(ext)


def top_folder(path: Column | str) -> Column:
    """First path segment; null for files at the root."""
    p = _col(path)
    return F.when(F.contains(p, F.lit("/")), F.substring_index(p, "/", 1))


def depth(path: Column | str) -> Column:
    """Number of slashes."""
    p = _col(path)
    return (F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))).cast("int")


def target_path(base: str, path: Column | str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), _col(path))


def file_id(path: Column | str) -> Column:
    """md5 of the normalised relative path, the same on every machine."""
    return F.md5(_col(path).cast("binary"))


def encode_target_uri(path: Column | str) -> Column:
    """Percent-encode everything but unreserved characters, keeping the slashes.

    ``url_encode`` writes form encoding, so four characters are put right after it.
    """
    form = F.url_encode(_col(path))
    for written, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        form = F.replace(form, F.lit(written), F.lit(wanted))
    return form


def convert_uri_scheme(uri: Column | str) -> Column:
    """``abfss://container@host/...`` to ``https://host/...``; other URIs are unchanged."""
    return F.regexp_replace(_col(uri), "^abfss://[^@]+@", "https://")


def path_prefixes(path: Column | str, shortest: int = 1) -> Column:
    """Array of the path and its ancestors holding at least ``shortest`` segments."""
    parts = F.split(_col(path), "/")
    n = F.size(parts)
    lengths = F.when(n >= shortest, F.sequence(F.lit(shortest), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(lengths, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
