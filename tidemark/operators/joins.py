"""Join helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def salted(df: DataFrame, seed: Column, salts: int) -> DataFrame:
    """Add ``salt`` so that rows of one hot key land in ``salts`` partitions."""
    return df.withColumn("salt", F.pmod(F.xxhash64(seed), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int) -> DataFrame:
    """The other side of :func:`salted`: each row once per salt value."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def row_hash(df: DataFrame) -> Column:
    """A hash that tells rows apart: of their id or grid place, or of all plain columns."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    known = [c for c in ("f_id", "FltyId", "bid", "id") if c in plain][:1] or [c for c in ("r", "c") if c in plain] or plain
    return F.xxhash64(*[F.col(f"`{c}`") for c in known])


def fenced(df: DataFrame, name: str) -> DataFrame:
    """The same rows; the generated loop of a stage ends here and another begins.

    HotSpot leaves methods above 8000 bytes interpreted unless a session sets
    ``-XX:-DontCompileHugeMethods``. Spark fuses a long plan into one such method, but runs a projection
    with a lambda, here the identity on a column that later steps read, outside of it and in small methods.
    """
    return df.withColumn(name, F.get(F.transform(F.array(f"`{name}`"), lambda x: x), F.lit(0)))


# copies of a small side that rows choose from
SPREAD = 16


# rows of a counted side that every task may hold
HELD = 100_000


def with_few(df: DataFrame, few: DataFrame, key: str, copies: int = SPREAD, counted: float = math.inf) -> DataFrame:
    """Rows joined with a small table of unique keys, a key of many rows split over ``copies`` tasks.

    The planner broadcasts the small side by its size; the copies matter where it is shuffled.
    Rows are dealt by their id or grid place, or by all plain columns where they have neither:
    one hash keeps the generated code of a long stage short. Where the caller has counted the small
    side (``counted`` rows) and every task can hold it, it is broadcast and no row moves.
    """
    if counted <= HELD:
        return df.join(F.broadcast(few), key)
    left = df.withColumn("_copy", F.pmod(row_hash(df), F.lit(copies)).cast("int"))
    right = few.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return left.join(right, [key, "_copy"]).drop("_copy")
