"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "scoria") -> SparkSession:
    """Return (or create) a session with the settings the engine relies on.

    On a cluster the master and most sizing come from spark-submit; the
    settings here only fill what is unset.  AQE stays on so shuffle
    partition counts and skewed joins are re-planned at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          .config("spark.ui.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if (master or "").startswith("local") and "spark.driver.memory" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        # local mode: the driver JVM is the only executor; the default 1 GB heap
        # forces cached tables to disk.  Half the machine, at most 16 GB.
        b = b.config("spark.driver.memory", f"{_local_heap_gb()}g")
    if os.environ.get("SCORIA_EVENT_LOG"):
        # opt-in profiling: Spark event log (job / stage timings) to this folder
        b = (b.config("spark.eventLog.enabled", "true")
              .config("spark.eventLog.dir", os.environ["SCORIA_EVENT_LOG"]))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _local_heap_gb() -> int:
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2 ** 30
    except (ValueError, OSError, AttributeError):
        total = 8
    return int(max(2, min(16, total // 2)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master
    gets a folder of its own where none is set; on a cluster a machine-local
    folder would lose data with its machine, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="scoria-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files (and checkpoints, where it cleans them) of frames that are no longer held; by
    itself it waits until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows up to which the smaller side of a join is broadcast (a few MB of narrow rows).
SMALL_SIDE_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few, else as it is
    (Spark then shuffles, and splits skewed keys).  The result is the same;
    count a table that is cheap to read, e.g. one cut from its lineage."""
    return F.broadcast(df) if df.count() <= max_rows else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than the
    cluster can run at once (a small file with few row groups).  On large
    inputs — many splits already — this is a no-op and adds no shuffle."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def by_group(df: DataFrame, cols, n_groups: int | None = None) -> DataFrame:
    """Hash-partition ``df`` on the grouping columns with an explicit count
    before ``groupBy(cols).applyInPandas``: AQE would coalesce a small input
    (e.g. one histogram row set per feature) into a single task and run
    every group's Python function serially.  The explicit partitioning also
    satisfies the groupBy, so no second shuffle is added."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    par = df.sparkSession.sparkContext.defaultParallelism
    n = par if n_groups is None else max(1, min(par, n_groups))
    return df.repartition(n, *cols)


_SHIPPED: dict[int, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``scoria`` importable in executor Python workers (pandas UDF bodies
    are pickled by module reference): zip the package once per process and
    add it with ``addPyFile`` once per SparkContext — what ``--py-files`` does."""
    import zipfile
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="scoria-pyfiles-"), "scoria.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED[key] = out
