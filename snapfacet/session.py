"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library assumes. Session time zone UTC keeps date arithmetic and the
# printing of timestamps stable; ANSI mode makes bad casts fail loudly (the strict
# casts of the transform rely on it); AQE re-plans joins and shuffle sizes at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The driver keeps a description of every plan and of each of its adaptive changes; those of long literals are megabytes.
    "spark.sql.maxPlanStringLength": "200000",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "snapfacet") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SNAPFACET_DRIVER_MEMORY", "16g"))
        # Collecting large task results failed in this container without it.
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings of BASE_CONF to an existing session (static ones are skipped)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory: the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without one (tests, trial runs) gets a scratch folder; on a cluster a folder of
    one machine would lose data, so there it is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="snapfacet-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapfacet-{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. How many tasks read it is a matter of the scan settings
    (``spark.sql.files.maxPartitionBytes``), not of this library."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``snapfacet`` importable in executor Python workers (what ``--py-files`` does):
    the package is zipped once per application and added with ``addPyFile``, which Spark
    distributes to every executor. Needed only where Python runs on executors (the
    stemmer UDF, ``zipWithIndex`` numbering); a no-op when already shipped."""
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="snapfacet-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(staging, "snapfacet"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir)
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)
