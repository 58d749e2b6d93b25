"""Relative URL resolution and query parameters as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelframe.functions import text as tx

_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.\-]*:"


def _resolve_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.array_join(kept, "/")
    trailing = F.when(last.isin(".", "..") & ~F.endswith(joined, F.lit("/")), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), F.concat(joined, trailing)).otherwise(path)


def join_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` the way a browser does."""
    origin = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, _SCHEME, 0)
    base_path = F.regexp_extract(base, r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    no_fragment = F.regexp_replace(base, r"#.*\z", "")
    no_query = F.regexp_replace(base, r"[?#].*\z", "")
    ref_path = F.regexp_extract(href, r"\A([^?#]*)", 1)
    ref_rest = F.regexp_extract(href, r"\A[^?#]*(.*)\z", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*\z", ""))
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, _resolve_dots(ref_path), ref_rest))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .otherwise(F.concat(origin, _resolve_dots(F.concat(folder, ref_path)), ref_rest))
    )


def query_parameter(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; NULL when absent."""
    query = F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)
    raw = tx.capture(query, rf"(?:\A|&){name}=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)
