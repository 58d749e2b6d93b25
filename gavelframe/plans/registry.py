"""The registry's state as a table that follows the log.

A refresh reads the files that are new or longer than at the last one, reduces
them to the latest record of each key, and puts those in the place of the keys'
earlier records; shards of other keys are not touched. The table notes which
files it holds and how long they were, so its note grows with the number of log
files and with nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe import schemas
from gavelframe.operators import registry as rg
from gavelframe.session import cut, passing_cuts, watched
from gavelframe.sources import pages, paths, records, tables

STATE = T.StructType(
    [
        T.StructField("record_key", T.StringType()),
        *schemas.REGISTRY.fields,
        T.StructField("file_name", T.StringType()),
        T.StructField("line_no", T.LongType()),
    ]
)


def _shard() -> Column:
    return F.substring(F.md5("record_key"), 1, 2)


def log_files(spark: SparkSession, log_path: str) -> dict[str, tuple[str, int]]:
    """Name in the log's order -> path and length of each file; nothing is opened."""
    listed = pages.list_files(spark, log_path)
    if listed is None:
        return {}
    rows = listed.select("path", "length", paths.path_key(F.col("path")).alias("name")).collect()
    return {r["name"]: (r["path"], r["length"]) for r in rows}


def refresh(spark: SparkSession, log_path: str, state_folder: str) -> dict[str, int]:
    """Bring the state up to the log; the number of files read and of keys that got a record.

    A line that is no record stops the refresh with its place, as it does a
    strict read. A file that has become longer is read again; its lines keep
    their places, so what was there before changes nothing.
    """
    known = tables.state(spark, state_folder).note.get("files", {})
    found = log_files(spark, log_path)
    new = sorted(path for name, (path, length) in found.items() if known.get(name) != length)
    if not new:
        return {"files": 0, "keys": 0}
    with passing_cuts(spark):
        log = records.read_registry(spark, new)
        delta = cut(rg.registry_index(log), "registry-delta")
        earlier = tables.read(spark, state_folder, STATE).join(delta.select("record_key"), "record_key", "left_semi")
        both = delta.select(*STATE.fieldNames()).unionByName(earlier.select(*STATE.fieldNames()))
        latest = rg.latest_by(both.drop("record_key"), rg.record_key(F.col("docid"), F.col("url")))
        latest, told = watched(latest.select(*STATE.fieldNames()), n=F.count(F.lit(1)))
        latest = cut(latest, "registry-latest")
        note = {"files": {name: length for name, (_, length) in found.items()}}
        tables.replace(latest, state_folder, _shard(), F.col("record_key"), note)
        return {"files": len(new), "keys": told("n")}


def index(spark: SparkSession, state_folder: str) -> DataFrame:
    """Latest record of each key, as ``registry_index`` gives it from the whole log."""
    return tables.read(spark, state_folder, STATE)
