"""Session settings and the shared scratch folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the results depend on, plus the adaptive features the plans rely on.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode; without this
    # limit the widest projections run as interpreted generated code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


_SHIPPED: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for a dot.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    ``spark-submit`` unless passed in.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    settings = {
        "spark__ui__enabled": "false",
        "spark__sql__shuffle__partitions": str(cores),
        "spark__driver__memory": "8g",
        # Tables of a few megabytes would otherwise be merged into one task.
        "spark__sql__adaptive__coalescePartitions__minPartitionSize": "128k",
        **conf,
    }
    session = build_session(master=f"local[{cores}]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing it is a folder of the warehouse, which
    executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application.

    Without it Python functions of the package run only where the cluster has
    the package on its path already.  Their rows hold whole texts, so they get
    a thousand rows at a time; the default batch is ten times as large.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    root = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(path))
    _SHIPPED["application"] = context.applicationId
