"""Session construction and shared scratch locations."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes: UTC civil time (DATETIME == UTC
# TIMESTAMP), AQE for runtime coalescing / skew splitting, case-insensitive
# name resolution (schemas are lower-case, files may not be).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "rastertab", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the package defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` as
    the session names it, else the warehouse location.  Never a machine-local
    temporary folder."""
    for key in ("spark.checkpoint.dir", "spark.sql.warehouse.dir"):
        configured = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
        if configured:
            return configured.rstrip("/")
    raise RuntimeError("name a folder all executors share in spark.checkpoint.dir")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the context, set from the shared folder when unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return sc.getCheckpointDir()


_made: list[str] = []  # scratch folders that this driver process named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder, for written intermediate
    tables (lineage cuts) and the tables that registered queries write."""
    path = f"{shared_folder(spark)}/rastertab/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def release_scratch(spark: SparkSession, since: int = 0) -> int:
    """Remove the scratch folders this driver has named (from the ``since``-th
    on), once nothing reads them any more: results of queries are read from
    them lazily, so write what is to stay elsewhere first.  Returns how many
    were there."""
    removed = 0
    for folder in _made[since:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    del _made[since:]
    return removed


def scratch_mark() -> int:
    """Place in the list of scratch folders, for ``release_scratch(since=...)``."""
    return len(_made)
