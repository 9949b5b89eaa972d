"""What operators need from a session: written intermediate tables, and this package on its Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripdemand.session import checkpoint_dir, on_workers, scratch_path

__all__ = ["on_workers", "stored", "written"]


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the folder that all executors share."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same as a compressed Parquet table, for what is large or read by few of its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
