"""Session helpers: where intermediate text may be written, and how a local test session is set up."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can see.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and executors share
    one machine, may fall back to a fresh temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="sheaftext-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under :func:`scratch_root` that no earlier run has used."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def local_session(app: str = "sheaftext", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # no call-site lookup per column expression: it makes up most of the time to build a wide plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the JVM never compiles methods above 8000 bytes; beyond that, split code beats one fused method
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
