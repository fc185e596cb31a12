"""Replacing a stored table without a moment in which a failed job has destroyed it.

The new rows are written beside the table. When that has succeeded, the old table is renamed away,
the new one renamed to its place, and the old one removed. A job that fails before leaves the old
table as it was. Should the driver die between the two renames, :func:`restore` puts the old table
back. The Hadoop file system of the path does the renames; where it is an object store, a rename
copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

STAGED, REPLACED = ".staged-", ".replaced-"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system knows it."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def publish(df: DataFrame, path: str, overwrite: bool, save: Callable[[DataFrameWriter, str], None]) -> None:
    """Runs ``save(writer, path)``. An existing path is refused, or replaced at the end with ``overwrite``."""
    fs, name = _hadoop(df.sparkSession, path)
    if not (overwrite and fs.exists(name)):
        save(df.write.mode("errorifexists"), path)
        return
    mark = uuid.uuid4().hex
    # hidden names: readers of the parent folder pass over them
    staged, replaced = (name.suffix("").getParent().suffix(f"/_{name.getName()}{kind}{mark}") for kind in (STAGED, REPLACED))
    try:
        save(df.write.mode("errorifexists"), staged.toString())
    except BaseException:
        fs.delete(staged, True)
        raise
    _rename(fs, name, replaced)
    try:
        _rename(fs, staged, name)
    except BaseException:
        _rename(fs, replaced, name)
        raise
    fs.delete(replaced, True)


def restore(spark: SparkSession, path: str) -> bool:
    """Puts back a table that was renamed away and not yet replaced. True if there was one."""
    fs, name = _hadoop(spark, path)
    if fs.exists(name) or not fs.exists(name.getParent()):
        return False
    left = [s.getPath() for s in fs.listStatus(name.getParent()) if s.getPath().getName().startswith(f"_{name.getName()}{REPLACED}")]
    if len(left) != 1:
        return False
    _rename(fs, left[0], name)
    return True
