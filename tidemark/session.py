"""Session settings that the operators rely on."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.master(master) if master else b
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where that is unset, as in tests, one in the warehouse.

    On a cluster for which neither is set the warehouse would be a folder of the driver alone: that is an error.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir")
    if not folder:
        if not conf.contains("spark.sql.warehouse.dir") and spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark"
    return folder.rstrip("/")


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets the session's limit on the bytes of an Arrow batch to BATCH_BYTES: a task holds a batch several times over as Python objects.

    The number of rows alone would not bound it where texts are long; a single longer text is a batch of its own.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) != f"{BATCH_BYTES}b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """small_batches for what runs inside; behind it the session's setting is as it was."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    small_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(name, before)
