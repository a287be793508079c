"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sifter",
                  driver_memory: str = "16g") -> SparkSession:
    """A local session configured like the cluster one: AQE on, UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir); only when
    neither is set and the master is local a private folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    ctx_dir = sc.getCheckpointDir()
    if ctx_dir:
        return ctx_dir
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sifter-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or os.path.abspath(local)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sifter`` importable in the executors' Python workers (the UDFs refer to its
    modules): zip the package once per application and register it with ``addPyFile``;
    the driver's file server then hands it to every executor. This is code, not data.
    On a cluster where the package is installed (or passed with ``--py-files``), set
    ``spark.sifter.shipPackage=false``. It is a no-op after the first call."""
    if spark.conf.get("spark.sifter.shipPackage", "true").lower() == "false":
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="sifter-pyfiles-"), "sifter.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


#: Rows and bytes per Arrow batch: bound a worker's memory when rows are long.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, by rows and by bytes (a batch has one row at least): a worker holds
    a few copies of a batch, and a task that chains Python functions has a worker for each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def ensure_workers(spark: SparkSession | None = None) -> None:
    """``ship_package`` and ``small_batches`` for the given or the active session (called where
    Python UDFs are built, so the library works from any working directory)."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)
        small_batches(spark)
