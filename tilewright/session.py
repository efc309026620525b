"""Session defaults and the one way this library cuts lineage or stages files."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tilewright", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass in your own."""
    master = f"local[{cores or '*'}]"
    builder = SparkSession.builder.master(master).appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": str(cores or 8),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows carry whole pixel blocks: bound Arrow batches by bytes, not by row count alone.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package (the ``--py-files`` of a submitted job), once per session."""
    if spark.conf.get("tilewright.shipped", None):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="tilewright-py-"), "tilewright_package")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "tilewright"))
    spark.conf.set("tilewright.shipped", "true")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local temporary folder is used only by a local master, where driver and
    executors are the same process; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tilewright-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that later plans start from it.

    Reliable checkpoints survive the loss of executors.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def cut_round(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for a table that goes round a loop of joins.

    A checkpoint keeps the size that the optimiser guessed, which for a join is the product of both sides': round
    by round its digits double, until the driver holds nothing else.  These rows start without a guess.
    """
    cut = cut_lineage(df)
    session = df.sparkSession
    return DataFrame(session._jsparkSession.createDataFrame(cut._jdf.javaRDD(), cut._jdf.schema()), session)
