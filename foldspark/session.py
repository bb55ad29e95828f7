"""Session settings the jobs rely on."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

DISK = StorageLevel.MEMORY_AND_DISK
_held: list[DataFrame] = []

# Runtime SQL settings for skewed data. They are applied only where the session
# has not chosen a value itself.
_SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when the join output feeds an aggregate on that key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the skew settings to a session, keeping explicit choices."""
    chosen = spark.sparkContext.getConf()
    for name, value in _SQL_SETTINGS.items():
        if not chosen.contains(name):
            spark.conf.set(name, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one beside the warehouse where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    beside = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    on_one_machine = master == "local" or master.startswith("local[")
    if not on_one_machine and beside.split(":", 1)[0] in ("file", beside):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is a local folder")
    return f"{beside}-checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to reliable storage so that executor loss cannot redo it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Session setting: the number of partitions kept frames are dealt into; unset, they stay as read.
SPREAD = "foldspark.partitions"


def spread(df: DataFrame) -> DataFrame:
    """Deal a frame that is about to be kept into the partitions the session asks for.

    Off by default: splits of the files size the tasks. A session on a few
    unsplittable files sets it, so that costly work on their rows uses every core.
    """
    partitions = df.sparkSession.conf.get(SPREAD, None)
    return df if partitions is None else df.repartition(int(partitions))


@contextmanager
def cached(df: DataFrame, columns: list[str] | None = None):
    """Keep some columns while several jobs read them. Lost blocks are recomputed.

    A frame that is already kept is only projected.
    """
    rows = df if columns is None else df.select(*columns)
    if df.is_cached:
        yield rows
        return
    rows = spread(rows).persist(DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def hold(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Keep an analysis table for the jobs of the running query; ``dealt`` ones stay in their partitions."""
    rows = (df if dealt else spread(df)).persist(DISK)
    _held.append(rows)
    return rows


def release_held() -> None:
    """Let go of the tables earlier queries kept."""
    while _held:
        _held.pop().unpersist()
