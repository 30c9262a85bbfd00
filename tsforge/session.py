"""Session construction and cluster-level settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on: UTC session zone (dates and the
# streaming watermark), Arrow for the few Python stages, AQE for partition
# coalescing and skew splitting at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, app: str = "tsforge", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so a cluster submit keeps its own master.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``tsforge`` importable in the executors' Python workers (pandas functions are pickled
    by reference): zip the package once per process and register it with ``addPyFile``."""
    import hashlib
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_tsforge_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(r, f) for r, _, fs in os.walk(pkg) for f in fs if f.endswith(".py"))
    digest = hashlib.sha1(b"".join(open(f, "rb").read() for f in files)).hexdigest()[:12]
    base = checkpoint_dir(spark)
    if "://" in base and not base.startswith("file:"):
        base = tempfile.gettempdir()  # the zip is only read by the driver; Spark serves it to executors
    path = os.path.join(base.replace("file:", ""), "pyfiles", f"tsforge-{digest}.zip")
    if not os.path.exists(path):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        tmp = f"{path}.{os.getpid()}.tmp"
        with zipfile.ZipFile(tmp, "w") as z:
            for f in files:
                z.write(f, os.path.relpath(f, os.path.dirname(pkg)))
        os.replace(tmp, path)
    sc.addPyFile(path)
    sc._tsforge_shipped = True


_LOCAL_DIR: str | None = None


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's process (``local``, ``local[8]``, ``local[4,2]``)."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; a cluster without it
    is an error. Only a local master (all tasks in this process) gets a scratch folder of its own,
    once per process."""
    global _LOCAL_DIR
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        opt = sc._jsc.sc().getCheckpointDir()
        d = opt.get() if opt.isDefined() else None
    if not d:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="tsforge-ckpt-", dir=os.environ.get("TSFORGE_SCRATCH", "/tmp"))
        d = _LOCAL_DIR
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut lineage of a DataFrame used by several downstream jobs: write it once as a parquet
    table under the shared ``spark.checkpoint.dir`` and read it back. The data is computed
    exactly once, survives executor loss (no local checkpoint), and later plans start from a
    plain file scan. Tables of one application share a folder, so its intermediates can be
    removed as a unit once it has finished."""
    import uuid
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{app}/{uuid.uuid4().hex}"  # one folder per application
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._tsforge_path = path
    return out


def discard(*tables) -> None:
    """Delete tables made by ``materialize`` that nothing reads any more. Frames that are not such
    tables are left alone."""
    for t in tables:
        path = getattr(t, "_tsforge_path", None)
        if path:
            jvm, conf = t.sparkSession._jvm, t.sparkSession._jsparkSession.sessionState().newHadoopConf()
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
            t._tsforge_path = None


_COSTLY = None


def reuse_input(df):
    """Make a DataFrame safe to read several times. If computing it needs a shuffle or a
    Python stage (an aggregation, window, shuffle join, pandas function...), write it once as a
    table in the shared folder (``materialize``) so later passes read the result instead of
    recomputing the lineage; plain scans, filters, projections and broadcast joins are returned
    unchanged."""
    global _COSTLY
    import re
    if _COSTLY is None:
        _COSTLY = re.compile(r"(?<!Broadcast)Exchange |InPandas|ArrowEvalPython|BatchEvalPython|MapInArrow")
    plan = df._jdf.queryExecution().executedPlan().toString()
    return materialize(df) if _COSTLY.search(plan) else df
