"""Tables that cut lineage, in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Narrow rows that are sent to every task at most; more go through a shuffle.
SEND_ROWS = 500_000
#: Bytes of an Arrow batch. Spark's 64 MB are held several times over by a task (vectors and buffers that grow by doubling, and
#: the Python worker's copy), outside the heap.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that Spark's Parquet reader decodes at once. Its 4096 texts or sets stand in arrays of tens of MB that double as they
#: grow; each takes regions of the heap in one piece, so the heap grows long before it is full.
READ_ROWS = 512
_READ = "spark.sql.parquet.columnarReaderBatchSize"
#: Row groups and pages of saved tables: what a task that writes or reads one holds of each column.
WRITER = {"parquet.block.size": 16 << 20, "parquet.page.size": 256 << 10}


def sendable(saved: DataFrame, limit: int = SEND_ROWS) -> DataFrame:
    """A saved table of narrow rows for a join: sent to every task if it is small, else shuffled."""
    return F.broadcast(saved) if saved.count() <= limit else saved


def row_id() -> Column:
    """A hash of doc_id and text: rows equal in both are one row; a null doc_id has one too."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"), F.col("doc_id").isNull())


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a single-machine session without one gets a temporary folder."""
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="chronoweave-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; the folder is scratch space
        pass


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session hold BATCH_BYTES at most, those of its Parquet reader READ_ROWS; lower limits stay. The
    session keeps them, as what an operator returns runs after the call."""
    for key, most in ((_BATCH, BATCH_BYTES), (_READ, READ_ROWS)):
        if int(spark.conf.get(key).rstrip("bB")) > most:
            spark.conf.set(key, most)


class Scratch:
    """Writes DataFrames as Parquet and reads them again, so that later stages restart from files, not from lineage."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_dir(spark)}/chronoweave-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(_delete, spark, self.root)

    def save(self, df: DataFrame, compression: str = "snappy", **options) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}"
        df.write.options(**{"compression": compression, **WRITER, **options}).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that no later plan reads."""
        for df in frames:
            _delete(self.spark, df._scratch_path)

    def free_shuffles(self) -> None:
        """Lets Spark delete the shuffle files of ended queries: its cleaner follows the collection of the driver's garbage,
        Python's references first, and a second round takes what the first one has set free."""
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)
