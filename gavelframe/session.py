"""Session settings and the shared folder for cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_BATCH_BYTES = 8 << 20
_OPEN_CUTS: ContextVar[tuple[list[str], ...]] = ContextVar("open_cuts", default=())

# What the jobs rely on; the caller's own values win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JIT compiles no method beyond 8000 bytes; longer stages run as separate, compiled projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "gavelframe", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get(_CHECKPOINT_SETTING) or spark.conf.get(_CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="gavelframe-")
    spark.conf.set(_CHECKPOINT_SETTING, folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, codec: str | None = None, outlives: bool = False, **options: str) -> DataFrame:
    """Write a table to the shared folder, with the writer's `options`, and continue from it.

    Later reads prune columns, need no recomputation, and survive the loss of
    any executor. A table that `outlives` the innermost `passing_cuts` is left
    to the one around that, if any.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, name)
    held = _OPEN_CUTS.get()[: -1 if outlives else None]
    if held:
        held[-1].append(folder)
    df.write.options(**options).parquet(folder, compression=codec)
    return spark.read.schema(df.schema).parquet(folder)


def compile_stages(spark: SparkSession) -> None:
    """Let the session run long stages as compiled projections from here on.

    For operators that return a DataFrame: it is planned when the caller runs
    it. A session that sets the limit lower keeps its own.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(DEFAULTS[name]):
        spark.conf.set(name, DEFAULTS[name])


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand whole texts to Python in batches of bounded bytes from here on.

    A worker holds a batch several times over: as Arrow data, as objects, and
    both again for what it gives back. A smaller limit of the session's own stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name)
    if not own.rstrip("bB").lstrip("-").isdigit() or not 0 < int(own.rstrip("bB")) <= _BATCH_BYTES:
        spark.conf.set(name, str(_BATCH_BYTES))


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """`bound_batches` for what is written inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let each write inside delete its shuffle files when it is through, instead of at some later collection of garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def compiled_stages(spark: SparkSession) -> Iterator[None]:
    """Run long stages as compiled projections inside, also in a session that somebody else has built.

    A session that sets the limit lower keeps its own.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    compile_stages(spark)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def passing_cuts(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `cut` writes inside, at the end. For runs that write their results before they return."""
    held: list[str] = []
    token = _OPEN_CUTS.set((*_OPEN_CUTS.get(), held))
    try:
        yield
    finally:
        _OPEN_CUTS.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in held:
            path = hadoop(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def watched(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Callable[[str], int]]:
    """The frame, and what gives a metric of it once a write of the frame is through, without a job of its own.

    Watch what is written itself, not one side of a join: a side that the other
    one makes needless is not run, nor counted.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in metrics.items()]), lambda name: seen.get[name]


def use_all_cores(df: DataFrame, pieces: int = 1) -> DataFrame:
    """Deal an input out evenly before costly text rules.

    Text rules cost far more than moving the rows, so one large row group would
    otherwise keep one core busy. With several pieces a core, a slow core does
    not keep the others waiting, and a lost piece is a small one.
    """
    return df.repartition(pieces * df.sparkSession.sparkContext.defaultParallelism)


def settle(df: DataFrame) -> DataFrame:
    """Same rows, with computed columns evaluated once at this point.

    The optimiser copies the expression of a column into every filter above
    it; for columns built from long rule chains that repeats the whole chain,
    several layers deep. Filters do not move below a generator, so a generator
    over each row's own values ends that, without leaving the task.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def spread_key(key: Column, usable: Column, *salt: Column) -> Column:
    """Join key whose unusable values (NULL, blank) are spread over all tasks.

    Rows that cannot match would otherwise all hash to one partition. The
    replacement starts with NUL, which no key has.
    """
    scattered = F.concat(F.lit("\x00"), F.xxhash64(*salt).cast("string"))
    return F.when(usable, key).otherwise(scattered)
