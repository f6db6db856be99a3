"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_DIRS: dict[str, str] = {}
_COPIES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def get_session(app: str = "shelfwise", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster also set `spark.sql.shuffle.partitions` for the data, some
    200 MB of shuffle each: adaptive execution merges partitions that turn out
    small, but splits no large ones, and range partitions and heavy-group cuts
    follow that number.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine, one for
    all operators of the application.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL_DIRS[context.applicationId]


def work_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/shelfwise/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage durably: the rows survive the loss of executors, later
    passes see identical content, and they read only the columns they need.
    `release` removes the copy, `clean_up` all copies of the application.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    _COPIES[copy] = path
    return copy


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(copy: DataFrame) -> None:
    """Remove the files of a table that `materialize` returned; it cannot be read after."""
    path = _COPIES.pop(copy, None)
    if path:
        _delete(copy.sparkSession, path)


def clean_up(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, when its results are written."""
    _delete(spark, work_dir(spark))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
