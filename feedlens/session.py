"""Session set-up and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a join whose hot key fills one partition is split at run time, also where
    # the split costs the aggregate above it another exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state of streams on the executors' disks, and only its changes in checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

RUNTIME_CONF = [k for k in SESSION_CONF if k.startswith(("spark.sql.adaptive.", "spark.sql.streaming."))]

#: of a table, as Spark estimates it, that each core may get in an exchange made only to use all cores
SPREAD_BYTES = 32 << 20

# the folder of the job that this thread is running, if it has one
_job_dir: ContextVar[str | None] = ContextVar("job_dir", default=None)

# application id -> folder of a local session that names none
_local_dirs: dict[str, str] = {}


def build_session(app: str = "feedlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Adaptive and streaming settings for a session that somebody else has built."""
    for key in RUNTIME_CONF:
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a fresh temporary folder, kept
    for the life of the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="feedlens-", dir="/tmp")
        named = _local_dirs[context.applicationId]
    return named.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder, or below that of the running job."""
    return f"{_job_dir.get() or shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """For a job that ends with everything saved: its intermediate tables are removed when it ends or fails.

    No frame made inside may be used afterwards, unless it reads saved data alone.
    Only the folder that is made here is removed.
    """
    folder = scratch_dir(spark, "job")
    outer = _job_dir.set(folder)
    try:
        yield
    finally:
        _job_dir.reset(outer)
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Py4JError as error:  # what remains is waste, not a fault of the job
            log.warning("%s is left: %s", folder, error)


def lookup_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table given in the program, as a local relation.

    Its size is known to the optimiser, which then broadcasts it by its own
    threshold; a table made from an RDD has no known size and is shuffled.
    """
    kind = StructType.fromDDL(schema)
    columns = [pa.array([row[i] for row in rows], to_arrow_type(f.dataType)) for i, f in enumerate(kind)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=kind.fieldNames()), kind)


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame by Spark's estimate; of a table read from files, their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out the rows of a scan that cannot use the cluster.

    One row group, one zipped file or one multi-line file is read by one task,
    however many byte splits it has, and per-text work would stay there. So a scan
    with fewer than two splits a core is shuffled if that gives a core no more than
    ``SPREAD_BYTES``, which costs little beside the work that follows; any larger or
    well split table is returned as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, *keys) if estimated_bytes(df) <= cores * SPREAD_BYTES else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    They survive the loss of any executor, are computed once however often they
    are used, and later readers fetch only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
