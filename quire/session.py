"""Session helpers.

Library code never creates its own session; it takes the caller's. These helpers
exist for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Spark's default: Catalyst only broadcasts what it can size.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``; we only
    pick a local scratch folder when nothing is configured (tests, local runs)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: configure through the session conf only
        sc = None
    configured = sc.getCheckpointDir() if sc is not None else None
    if configured:
        return configured
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's checkpoint folder (shared on a cluster)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers wherever the driver was started
    (UDFs defined in this package are pickled by reference). Spark distributes the
    zip to executors itself; it is built once per session."""
    import io
    import zipfile

    if getattr(ship_package, "_shipped", None) == id(spark):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(os.path.join(root, "quire")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    path = os.path.join(tempfile.mkdtemp(prefix="quire-pkg-"), "quire.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    try:
        spark.sparkContext.addPyFile(path)
    except Exception:  # Spark Connect sessions have no SparkContext
        spark.addArtifacts(path, pyfile=True)
    ship_package._shipped = id(spark)


def posix_scratch(spark: SparkSession, name: str) -> str:
    """``scratch_path`` as a POSIX path for Python file I/O on executors (binary shard
    writers); the checkpoint folder must then be a shared mount."""
    path = scratch_path(spark, name)
    if path.startswith("file://"):
        path = path[len("file://"):]
    elif path.startswith("file:"):
        path = path[len("file:"):]
    elif "://" in path:
        raise ValueError(f"binary shards need a POSIX-mounted shared folder, got {path}")
    return path
