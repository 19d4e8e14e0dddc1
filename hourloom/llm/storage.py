"""Stage tables in the shared folder, and their removal once nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hourloom.session import cut_lineage


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written below spark.checkpoint.dir and read back: computed once, and safe when executors are lost."""
    return cut_lineage(df, label)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = files.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark) -> None:
    """Rows hold whole texts, so fewer of them than usual go to a Python worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
