"""Derived path and digest columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.functions import text as tx


def digest(docid: Column, url: Column) -> Column:
    """First 16 hex characters of SHA-256 of the docid, or of the URL when it is blank."""
    return tx.prefix(F.sha2(F.coalesce(tx.null_if_empty(docid), url), 256), cb.DIGEST_CHARS)


def digest_path(folder: str, docid: Column, url: Column) -> Column:
    """``<folder>/<2 hex>/<16 hex>.html``."""
    d = digest(docid, url)
    return F.concat(F.lit(folder.rstrip("/") + "/"), tx.prefix(d, cb.SHARD_CHARS), F.lit("/"), d, F.lit(".html"))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def reroot(path: Column, old_root: str, new_root: str, suffix: str | None = None) -> Column:
    """Move a path below another root, optionally with a new suffix; NULL if not below ``old_root``."""
    old = old_root.rstrip("/")
    relative = F.regexp_extract(path, rf"\A{re.escape(old)}/(.+)\z", 1)
    if suffix is not None:
        relative = F.concat(F.regexp_replace(relative, r"(?<=[^/])\.[^./]+\z", ""), F.lit(suffix))
    return F.when(F.startswith(path, F.lit(old + "/")), F.concat(F.lit(new_root.rstrip("/") + "/"), relative))


def extracted_path(raw_html_path: Column, raw_root: str, extracted_root: str) -> Column:
    return reroot(raw_html_path, raw_root, extracted_root, ".json")


def annotation_path(extracted: Column, extracted_root: str, annotation_root: str) -> Column:
    return reroot(extracted, extracted_root, annotation_root)


def path_key(path: Column, root: str | None = None) -> Column:
    """One name for a file however its path is written: URI, absolute, or relative.

    Scheme, host and doubled slashes go. With ``root``, so does the way to it,
    whole or from any folder on it, which leaves the path below the root.
    """
    bare = F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "/{2,}", "/"), r"\A(?:\./)+", "")
    if root is None:
        return bare
    parts = [p for p in re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", root).split("/") if p not in ("", ".")]
    ways = "|".join(re.escape("/".join(parts[k:])) for k in range(len(parts)))
    return F.regexp_replace(bare, rf"\A/?(?:{ways})/", "") if ways else bare


def file_stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]+\z", "")


def shard(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1)
