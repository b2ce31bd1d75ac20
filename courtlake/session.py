"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
#: Generated methods of more bytes are never compiled by the JVM.
COMPILED_BYTES = 8000


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are tuned for; anything in ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Spark checks sizes against this before it broadcasts a side. The one
        # broadcast this package asks for is a work list it has measured.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        # Wide typed projections make methods the JVM would not compile; beyond its
        # limit of 8000 bytes Spark then splits them instead.
        METHOD_LIMIT_CONF: str(COMPILED_BYTES),
        # Call sites are looked up once per column expression; the jobs build thousands.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """While it is open, Spark splits generated methods that the JVM would not compile.

    :func:`build_session` sets this for good; a job may run in any session, which has its own limit
    back afterwards. A lower limit stays as it is.
    """
    before = spark.conf.get(METHOD_LIMIT_CONF)
    if int(before) <= COMPILED_BYTES:
        yield
        return
    spark.conf.set(METHOD_LIMIT_CONF, str(COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT_CONF, before)


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    base = spark.conf.get(SHARED_DIR_CONF, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR_CONF} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="courtlake-")
        spark.conf.set(SHARED_DIR_CONF, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder for one run below the shared folder."""
    return f"{shared_base(spark)}/courtlake/{name}-{uuid.uuid4().hex}"


def written_once(spark: SparkSession, df, name: str):
    """Compute ``df`` into a file of the shared folder and read it from there, each time it is used."""
    path = shared_dir(spark, name)
    with compiled(df.sparkSession):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reliable_checkpoint(spark: SparkSession, df):
    """Materialize ``df`` in the shared folder and cut its lineage."""
    shared_base(spark)
    return df.checkpoint(eager=True)
