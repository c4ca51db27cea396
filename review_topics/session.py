"""Session settings, lineage cuts and the size checks that guard every broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A topic table larger than this is not broadcast.
MAX_TOPICS = 10_000
# Keys that own more than 1/HOT_SHARE of all rows are "hot"; there can be at most HOT_SHARE of them.
HOT_SHARE = 1_000
# Partitions-to-be of one hot key.
SALTS = 4_096
# Where a session keeps the stages of its open temporary_stages; modules hold nothing that cannot be sent to a task.
_SCOPES = "_open_stage_scopes"


def build_session(cores: str = "*", app: str = "review_topics", **conf: str) -> SparkSession:
    """Local session for tests and bench. On a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    return spark


def local_scratch(spark: SparkSession) -> None:
    """Give a local session, whose executors all share this machine, a folder that goes when the session ends.

    Nothing happens where a folder is named already, and on a cluster none is made up.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or context.master.split("[")[0] != "local":
        return
    folder = tempfile.mkdtemp(prefix="review-topics-")
    context.setCheckpointDir(folder)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to Parquet in the shared folder and read it back (columnar, prunable).

    The table survives the loss of the executors that made it, and the plan that reads it starts anew: nothing of the old
    plan, its constraints included, is carried on. ``unstage`` deletes it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    if scopes := getattr(df.sparkSession, _SCOPES, None):
        scopes[-1].append(staged)
    return staged


def stage_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """A stage and aggregates over its rows, gathered while it is written."""
    seen = Observation()
    staged = stage(df.observe(seen, *[value.alias(key) for key, value in metrics.items()]), name)
    return staged, seen.get


def stage_counted(df: DataFrame, matches: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """A stage for ``hot_lookup`` with what it must know of the column ``matches``."""
    return stage_observed(df, "step", most=F.max(matches), total=F.sum(matches), **metrics)


def unstage(*staged: DataFrame) -> None:
    """Delete stages that nothing reads any more."""
    for df in staged:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the stages that the session makes inside once the block has ended well, all but those passed to the given function.

    What leaves the block must be written by then: a stage that was kept, or nothing that reads a stage.
    """
    if not hasattr(spark, _SCOPES):
        setattr(spark, _SCOPES, [])
    scopes: list[list[DataFrame]] = getattr(spark, _SCOPES)
    made: list[DataFrame] = []
    kept: list[str] = []
    scopes.append(made)

    def keep(staged: DataFrame) -> DataFrame:
        kept.append(staged._staged_at)
        return staged

    try:
        yield keep
    finally:
        scopes.pop()
    for staged in made:
        if staged._staged_at not in kept:
            unstage(staged)
        elif scopes:
            scopes[-1].append(staged)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their job has ended, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()).exists(found)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows without the plan that made them; for the steps of a loop."""
    return stage(df, "step")


def broadcast_checked(df: DataFrame, max_rows: int = MAX_TOPICS) -> DataFrame:
    """Broadcast ``df`` only after counting it; a larger one is left to an ordinary shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_lookup(left: DataFrame, right: DataFrame, on: list[str], matches: str, known: dict | None = None) -> DataFrame:
    """Inner equi join of ``left`` with a unique-key ``right`` that survives hot keys.

    ``right[matches]`` says how many ``left`` rows carry the key, so the keys holding more than
    1/HOT_SHARE of all rows are known without another pass over ``left`` and number at most HOT_SHARE.
    Their rows pass the shuffled join under a salt that spreads them over many partitions and matches nothing
    there, and get their values from a broadcast of the few hot keys instead. ``left`` is read once. Where ``known``, see
    stage_counted, says that no key is hot, what is left of all this is the shuffled join.
    """
    if known is not None and (known["most"] or 0) * HOT_SHARE <= (known["total"] or 0):
        values = [c for c in right.columns if c not in on and c != matches]
        return left.join(right.drop(matches), on).select(*left.columns, *values)
    total = right.agg(F.sum(matches)).scalar()
    is_hot: Column = F.col(matches) * F.lit(HOT_SHARE) > total
    values = [c for c in right.columns if c not in on and c != matches]
    packed = F.struct(*values) if values else F.lit(True)
    hot = right.where(is_hot).select(*on, packed.alias("_hot"))
    cold = right.where(~is_hot).select(*on, F.lit(0).alias("_salt"), packed.alias("_cold"))
    marks = F.broadcast(hot.select(*on, F.lit(True).alias("_is_hot")))
    salt = F.when(F.col("_is_hot"), 1 + F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    spread = left.join(marks, on, "left").withColumn("_salt", salt).drop("_is_hot")
    met = spread.join(cold, [*on, "_salt"], "left").join(F.broadcast(hot), on, "left")
    found = met.withColumn("_value", F.coalesce("_cold", "_hot")).where(F.col("_value").isNotNull())
    return found.select(*left.columns, *[F.col(f"_value.{c}").alias(c) for c in values])
