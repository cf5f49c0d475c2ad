"""Carrying the columns of a table, whatever their names, past those that an operator adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of just this name, dots and quotes in it too."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, *named: str) -> DataFrame:
    """The named columns, and all others as one column `extra`."""
    others = [c for c in df.columns if c.lower() not in named]
    return df.select(*named, (F.struct(*map(quoted, others)) if others else F.lit(None).cast("int")).alias("extra"))


def unpacked(df: DataFrame, like: DataFrame, *named: str) -> DataFrame:
    """df, from packed(like, *named), with the columns of `like` alone."""
    return df.select(*((F.col(c.lower()) if c.lower() in named else F.col("extra").getField(c)).alias(c) for c in like.columns))
