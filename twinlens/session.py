"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import contextvars
import os
import re
import tempfile
import weakref

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "twinlens") -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster, use the cluster's session instead; the jobs in the package
    only read settings from the session they are given, but for ``bounded_batches``.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Arrow batches to Python are cut by bytes too: a batch of decoded
        # images stays bounded whatever the row count
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Most bytes of an Arrow batch of whole texts.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python stay within ``BATCH_BYTES`` in this session from now on; a smaller limit stays.

    A worker holds a batch several times over (Arrow, Python objects, results),
    and Spark fills one with up to 10 000 rows or 64 MB: whole texts then take
    more memory the more of them a partition has. Spark reads the limit when a
    plan runs, so it can't be given back when a lazy frame is returned. Rows
    are the same for any batch size.
    """
    number, unit = re.match(r"\s*(\d+)\s*([kmgt]?)", spark.conf.get(_BATCH_KEY).lower()).groups()
    if int(number) << " kmgt".index(unit or " ") * 10 > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is
    unset in local mode (tests) a fresh scratch folder is made and registered.
    On a cluster executors would each write to their own disk, so it is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="twinlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_RUNS: dict[str, str] = {}
_OPEN: contextvars.ContextVar[tuple[Lifetime, ...]] = contextvars.ContextVar("open_lifetimes", default=())
_WRITTEN: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _run_folder(spark: SparkSession) -> str:
    """This session's own folder under the shared one; it goes when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        path = f"{checkpoint_dir(spark).rstrip('/')}/twinlens-{os.urandom(6).hex()}"
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _RUNS[app] = path
    return _RUNS[app]


class Lifetime:
    """What is written to scratch paths while it is open goes when it closes, also after an error (M6).

    ``with lifetime(spark) as own: ...``. Lifetimes nest: a path belongs to the
    innermost open one, or to the session if none is open. ``own.keep(df)`` hands
    a table that ``materialize`` returned over to the next outer one. Frames
    that read a table must be used up, or written elsewhere, before it closes.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        path = _WRITTEN[df]
        self.paths.remove(path)
        outer = [x for x in _OPEN.get() if x is not self]
        if outer:
            outer[-1].paths.append(path)
        return df

    def __enter__(self) -> Lifetime:
        _OPEN.set((*_OPEN.get(), self))
        return self

    def __exit__(self, *error) -> None:
        _OPEN.set(tuple(x for x in _OPEN.get() if x is not self))
        for path in self.paths:
            _delete(self.spark, path)
        self.paths = []


def lifetime(spark: SparkSession) -> Lifetime:
    return Lifetime(spark)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` returned, when all that is made of it has been written; others stay."""
    path = _WRITTEN.pop(df, None)
    if path is None:
        return
    for own in _OPEN.get():
        if path in own.paths:
            own.paths.remove(path)
    _delete(df.sparkSession, path)


def settled(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """A bounded report (a few rows by its nature) as a frame of its own, which reads no table any more."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"not a bounded report: over {limit} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, owned by the innermost open ``lifetime``."""
    path = f"{_run_folder(spark)}/{name}-{os.urandom(6).hex()}"
    if _OPEN.get():
        _OPEN.get()[-1].paths.append(path)
    return path


def materialize(df: DataFrame, name: str = "features") -> DataFrame:
    """Write once to the shared checkpoint folder and read back (M6).

    Later epochs, modes and reports scan the parquet copy: the encoders run
    once, and a lost executor re-reads files instead of recomputing lineage.
    One job computes the rows (an RDD checkpoint of an unpersisted plan would
    compute them twice). The table goes with its ``lifetime``, or with the session.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    _WRITTEN[out] = path
    return out


#: Inputs up to this size are dealt out anew where their scan has few splits.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin a small input over the cores.

    A parquet file of one row group scans as one task, and per-row heavy work
    (tokenising, hashing, Arrow UDFs) would then run on one core. The size is
    the optimizer's own estimate, so nothing is listed or run for it; inputs
    above ``SPREAD_BYTES``, and those without an estimate, pass through
    unchanged, so no large table is ever shuffled here.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_BYTES:
        return df
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
