"""Where intermediate tables go: a folder that the driver and every executor see."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession


_open_lists: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """A list that gets the path of every folder made meanwhile, so that its owner can drop them."""
    folders: list[str] = []
    _open_lists.append(folders)
    try:
        yield folders
    finally:
        _open_lists.remove(folders)


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that `new_folder` made; what reads them must be done."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession) -> str:
    """A fresh path under `spark.checkpoint.dir`, or under the warehouse where that is unset.

    A local warehouse is refused when the executors are on other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local = urlparse(shared).scheme in ("", "file")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{shared.rstrip('/')}/tablespan-{uuid.uuid4().hex}"
    for folders in _open_lists:
        folders.append(path)
    return path


def kept(spark: SparkSession, frame: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """The frame written once to the shared folder and read back: its lineage ends there.

    A task holds a row group while it writes and up to 4,096 rows of one while it reads. Where rows are
    large, `group_bytes` bounds both: a group ends with the row that reaches it.
    """
    path = new_folder(spark)
    writer = frame.write
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 16)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def kept_and_measured(spark: SparkSession, frame: DataFrame, *measures: Column) -> tuple[DataFrame, tuple]:
    """The frame kept, and aggregates over its rows, taken while they are written: one job and no second read."""
    seen = Observation()
    named = [measure.alias(f"m{i}") for i, measure in enumerate(measures)]
    frame = kept(spark, frame.observe(seen, *named))
    values = seen.get
    return frame, tuple(values[f"m{i}"] for i in range(len(named)))
