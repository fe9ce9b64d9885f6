"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    The files survive a lost executor and are read by every task of every
    machine; the caller owns the table (nothing deletes it behind its back).
    """
    path = session.scratch_table_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that new ones of these names replace (as ``withColumn`` would)."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


_BLOCK = 256


def _sums_from_zero(a: Column) -> Column:
    return F.aggregate(a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def running_sums(a: Column) -> Column:
    """Inclusive prefix sums of an int array, by blocks: appending to one accumulator would copy it per element."""
    def build(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")),
                             lambda b: _sums_from_zero(F.slice(v, b * _BLOCK + 1, _BLOCK)))
        return let(blocks, lambda bl: let(
            _sums_from_zero(F.transform(bl, lambda x: F.element_at(x, -1))), lambda off: F.flatten(F.transform(
                bl, lambda x, b: F.transform(F.slice(x, 2, _BLOCK), lambda s: s + F.get(off, b))))))

    return let(a, lambda v: F.when(F.size(v) > 0, build(v)).otherwise(v))
