"""Shared folder for tables that cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Without the setting it lies in the warehouse, which every session has and a cluster shares.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables that are made inside the block at its end, also after an error.

    For blocks whose results are complete: written, counted or collected. DataFrames that
    were built inside and are still to run read those tables and would fail. Blocks nest; each
    removes its own tables, those made in other threads stay.
    """
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
