"""Tables of the operators: named columns of an input, and written intermediate results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import scratch_path


# A written table of so many rows of a few numbers may be broadcast (some 30 MB); beyond, joins shuffle.
BROADCAST_ROWS = 500_000

# Whole texts and packed keys are wide rows: an Arrow batch takes few of them, in the memory of the executor as in the
# worker's.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES, BYTES_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

# A task that reads Parquet holds so many rows of each column at once.
READ_SETTING = "spark.sql.parquet.columnarReaderBatchSize"

# A task holds the rows of a Parquet file it writes until they are so many bytes, and reads whole groups of them.
GROUP_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits of an Arrow batch to ``BATCH_ROWS`` and ``BATCH_BYTES``, and of rows read at once."""
    for setting in (BATCH_SETTING, READ_SETTING):
        if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
            spark.conf.set(setting, str(BATCH_ROWS))
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if not 0 < in_bytes(spark.conf.get(BYTES_SETTING)) <= BATCH_BYTES:
        spark.conf.set(BYTES_SETTING, f"{BATCH_BYTES}b")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


class Workspace:
    """Intermediate tables in the shared folder; a written table cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.count = 0
        bound_batches(spark)

    def keep(self, df: DataFrame, repeats: bool = True) -> DataFrame:
        """Write a table and read it back. Without ``repeats`` no dictionary of its values is tried."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        schema = df.schema
        options = {"compression": "snappy", "parquet.block.size": GROUP_BYTES, "parquet.enable.dictionary": repeats}
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def small(self, kept: DataFrame) -> DataFrame:
        """A kept table, marked for broadcast if its rows, counted, are few."""
        return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept

    def forget(self, df: DataFrame) -> None:
        """Remove a table that :meth:`keep` wrote and that no later result reads."""
        for file in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
