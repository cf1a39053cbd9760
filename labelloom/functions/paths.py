"""Paths, extensions and dataset keys as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions that are images unless told otherwise.
DEFAULT_EXTENSIONS = (".png", ".jpg", ".jpeg", ".bmp", ".tif", ".tiff")
UNKNOWN = "_unknown_"


def extensions(exts: str | list[str] | None) -> set[str] | None:
    """None: any extension. "all" accepts everything, "+a,+b" adds to the defaults, "a,b" or a list replaces them; all are lower case with a leading dot."""
    if exts is None:
        return set(DEFAULT_EXTENSIONS)
    parts = [x.strip().lower() for x in (exts.split(",") if isinstance(exts, str) else exts) if x.strip()]
    if parts == ["all"]:
        return None
    added = [x[1:] for x in parts if x.startswith("+")]
    plain = [x for x in parts if not x.startswith("+")]
    dot = lambda x: x if x.startswith(".") else "." + x
    return {dot(x) for x in plain + added} | (set(DEFAULT_EXTENSIONS) if added or not plain else set())


def basename(path: str | Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def suffix(name: str | Column) -> Column:
    """From the last dot of the basename on, in lower case; a name that only begins with a dot has none."""
    return F.lower(F.regexp_extract(basename(name), r"^.+(\.[^.]+)$", 1))


def has_extension(name: str | Column, exts: str | list[str] | None = None) -> Column:
    allowed = extensions(exts)
    return F.lit(True) if allowed is None else suffix(name).isin(sorted(allowed))


def label_first(path: str | Column, root: str | Column) -> Column:
    """The first folder below root; null for a file that lies in root itself or elsewhere."""
    path, root = (F.col(x) if isinstance(x, str) else x for x in (path, root))
    below = F.when(F.startswith(path, F.concat(root, F.lit("/"))), F.substring(path, F.length(root) + 2, F.length(path)))
    parts = F.split(below, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, 1))


def label_parent(path: str | Column) -> Column:
    """The folder that the file lies in."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, -2))


def split_dataset_key(dataset: str | Column) -> tuple[Column, Column]:
    """(owner, slug) of "owner/slug" with one slash; anything else gives the unknown pair."""
    name = F.trim(F.col(dataset) if isinstance(dataset, str) else dataset)
    ok = F.coalesce(name.rlike("^[^/]+/[^/]+$"), F.lit(False))
    return tuple(F.when(ok, F.element_at(F.split(name, "/"), i)).otherwise(F.lit(UNKNOWN)) for i in (1, 2))
