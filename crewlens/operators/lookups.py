"""Joins with folded tables (distinct keys, one row per key) where a key may be frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.session import stored


def own_exchange(df: DataFrame, key: str) -> DataFrame:
    """The table, dealt out anew by a join on the key instead of as its last fold or join left it.

    Adaptive execution splits a frequent key only between two exchanges that a join asked for. Spark
    does not see that the changed key equals the old one.
    """
    c = F.col(key)
    same = F.concat(c, F.lit("")) if isinstance(df.schema[key].dataType, T.StringType) else c.bitwiseXOR(F.lit(0))
    return df.withColumn(key, same.cast(df.schema[key].dataType))


def without_lost(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of a stored table whose `on` occurs in the stored `keys`, like a left semi join.

    Ids are looked up alone, each once: what is stored are those not found. These are few in sound data,
    and whole rows then meet them by a broadcast; if they are many, Spark joins by a shuffle.
    """
    asked = df.select(on).filter(F.col(on).isNotNull())
    lost = stored(asked.distinct().join(keys.select(on), on, "left_anti"), "lost")
    return df.filter(F.col(on).isNotNull()).join(lost, on, "left_anti")
