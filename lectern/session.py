"""What a job needs from its session: a shared folder that outlives executors, and safe settings."""
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings for a session of one's own. A cluster's own values should win over the size-dependent ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rules are built from many small column expressions; recording a call site for each is most of the build time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. A folder of our own serves only where all runs on this machine (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    named = named or sc.getCheckpointDir()
    if named is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="spark-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are in the shared folder, so losing executors costs nothing."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for jobs that write and read back."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _SCRATCH.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables under paths made inside are removed at its end, so what is computed inside must be written to a path made before."""
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        made = _SCRATCH.get()
        _SCRATCH.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a source over the whole cluster by its key.

    In-row text work costs far more than one shuffle of the source, and the number of splits does not tell how many of them hold rows: a Parquet
    row group is read by one task, however many splits its file is cut into, and small files share a split. A source that has both files and splits
    enough is spread as it is.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if min(len(df.inputFiles()), splits) >= wanted else df.repartition(max(wanted, splits), key)
