"""Extraction and annotation of growing folders with Structured Streaming.

The stream checkpoint takes the place of the search for missing outputs: a
file that was handled is not read again, and a restart goes on where the last
committed batch ended. ``availableNow`` drains what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gavelframe import schemas
from gavelframe.functions.html import COURT_LAYOUT, PageLayout
from gavelframe.operators import coding
from gavelframe.operators import extraction as ex
from gavelframe.session import compiled_stages
from gavelframe.sources import pages as pg
from gavelframe.sources import records

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def extract_stream(
    spark: SparkSession,
    raw_folder: str,
    extracted_folder: str,
    quarantine_folder: str,
    checkpoint: str,
    layout: PageLayout = COURT_LAYOUT,
    files_per_batch: int = 100_000,
) -> StreamingQuery:
    """New page files below ``raw_folder`` become extracted judgments."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", "*.html")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(raw_folder)
    )
    rows = ex.extract_pages(pg.decoded(files.withColumnRenamed("path", "raw_html_path")), layout)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten on a replay, so a retry adds nothing twice.
        failed = F.col(ex.ERROR).isNotNull()
        batch.persist()  # pages are taken apart once for both writes
        batch.where(~failed).drop(ex.ERROR).write.mode("overwrite").parquet(f"{extracted_folder}/batch={batch_id}")
        batch.where(failed).select("raw_html_path", ex.ERROR).write.mode("overwrite").parquet(
            f"{quarantine_folder}/batch={batch_id}"
        )
        batch.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def annotate_stream(
    spark: SparkSession,
    extracted_folder: str,
    log: DataFrame | str,
    annotation_folder: str,
    checkpoint: str,
    quarantine_folder: str | None = None,
    raw_folder: str | None = None,
) -> StreamingQuery:
    """New extracted judgments become annotations; what fails goes to the quarantine.

    A log given by its path is read afresh per batch. Without a folder of its
    own, the quarantine lies beside the annotations.
    """
    bad_folder = quarantine_folder or f"{annotation_folder.rstrip('/')}-quarantine"
    extracted = (
        spark.readStream.schema(schemas.EXTRACTED).option("recursiveFileLookup", True).parquet(extracted_folder)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        known = records.read_registry(spark, log) if isinstance(log, str) else log
        rows = coding.stamp(coding.annotate_with_log(batch, known, root=raw_folder)).persist()
        with compiled_stages(spark):
            rows.where("error_message is null").select(*schemas.ANNOTATION.fieldNames()).write.mode("overwrite").parquet(
                f"{annotation_folder}/batch={batch_id}"
            )
        failed = rows.where("error_message is not null").select("html_id", "raw_html_path", "error_message")
        failed.write.mode("overwrite").parquet(f"{bad_folder}/batch={batch_id}")
        rows.unpersist()

    return (
        extracted.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
