"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that only make sense for local runs (tests, bench). On a cluster the
# deployment owns them; ``local_session`` never overrides a value already set.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # remove checkpoint files of RDDs that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | str = 8, app: str = "tastemine") -> SparkSession:
    """A local[N] session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point to shared storage (HDFS / object
    store) and is read from the session. Only where driver and executors are
    one process (local tests) is a scratch folder chosen when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tastemine-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def checkpoint(df, eager: bool = True, few: bool = False):
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss). A table that is much smaller than the
    input (``few``) is written in as many files as there are cores, not in one for each shuffle partition: creating
    thousands of tiny files costs more than writing them."""
    ensure_checkpoint_dir(df.sparkSession)
    if few:
        df = df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))
    return df.checkpoint(eager=eager)


def held(df) -> tuple:
    """A ``checkpoint`` of ``df`` for one step, in the partitions that ``df`` has, and a function that removes its files, which
    otherwise stay where the deployment does not clean checkpoints. The step calls it when no plan reads the copy any more."""
    out = checkpoint(df)
    path = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    return out, lambda: _removed(out.sparkSession, path)


def _removed(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df, compression: str = "zstd"):
    """A reliable copy of ``df`` as Parquet files under ``spark.checkpoint.dir``. Unlike a checkpoint, which is
    serialised row by row and not compressed, it is columnar, read by the columns that are needed, and known by its size: a join
    with a small stored table is a broadcast from the start, the other side is not shuffled."""
    return scratch(df, compression)[0]


def scratch(df, compression: str = "zstd") -> tuple:
    """A ``stored`` copy of ``df`` for one step, and a function that removes its files. The step calls it when its own result is
    stored, so that no plan, a lost executor's tasks among them, reads the copy any more."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), lambda: _removed(spark, path)


def settled(df, key: str | None = None, rounds: int = 1):
    """``stored``, for a stage table: the shuffles that it was made by are released, so that the disk holds one stage's at a
    time and not the sum of all stages'. In several ``rounds``, each makes the rows of its share of the values of column
    ``key`` and releases its shuffles. The column should be one of the rows that ``df`` starts from, so that other rows leave at the scan."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    for i in range(rounds):
        share = df if rounds == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == i)
        share.write.mode("append").option("compression", "zstd").parquet(path)
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def rounds_for(rows: int, rows_per_round: int = 8_000_000, most: int = 8) -> int:
    """Rounds of a stage that may shuffle whole rows: one for small tables, and no more than ``most``, as each reads all rows."""
    return min(most, 1 + rows // rows_per_round)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files that no plan refers to any more. Its cleaner learns of them when the driver collects
    garbage, by default every 30 minutes; a loop or chain whose steps each shuffle about the input or more calls this after a step."""
    gc.collect()
    # the JVM is told of freed plans by a thread that sleeps a second at a time: what it has not passed on would keep their shuffles
    freed = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while freed:
        try:
            task = freed.pop()
        except IndexError:
            break
        if not isinstance(task, tuple):  # the thread's sign to end
            freed.append(task)
            break
        client, target = task
        client.garbage_collect_object(target, False)
    spark.sparkContext._jvm.System.gc()


def observed(df, **metrics) -> tuple:
    """A stored copy of ``df`` and the ``metrics`` (aggregate columns) of its rows, gathered by the tasks that
    write it: counting costs no second read. They are a handful of numbers, whatever the rows."""
    from pyspark.sql import Observation

    told = Observation()
    out = stored(df.observe(told, *[c.alias(name) for name, c in metrics.items()]))
    return out, told.get


def partitions_for(rows: int, rows_per_partition: int = 100_000) -> int:
    """Partition count of a small input that an ML fit reads many times: a
    function of the data alone, so results do not depend on the cluster."""
    return max(1, -(-rows // rows_per_partition))
