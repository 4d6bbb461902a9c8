"""Loads with different columns and types, read as one table.

The schema of every load is taken from its files; columns that a load lacks are
NULL in it, and a number column takes the widest type that any load has. The
table is then one scan with that schema. A column whose types have no common
one is refused, before anything is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType

#: Types that the reader takes as each wider one without loss.
WIDER: dict[type[DataType], tuple[type[DataType], ...]] = {
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}


def common_type(name: str, a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return common_schema([a, b], f"{name}.")
    if type(b) in WIDER.get(type(a), ()):
        return b
    if type(a) in WIDER.get(type(b), ()):
        return a
    raise TypeError(f"column {name} is {a.simpleString()} in one load and {b.simpleString()} in another")


def common_schema(schemas: list[StructType], prefix: str = "") -> StructType:
    """All columns in the order in which they first occur, nullable, names compared without case."""
    found: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = found.get(f.name.lower())
            type_ = f.dataType if known is None else common_type(prefix + f.name, known.dataType, f.dataType)
            found[f.name.lower()] = StructField(known.name if known else f.name, type_, True)
    return StructType(list(found.values()))


def read_loads(spark: SparkSession, loads: list[str]) -> DataFrame:
    """One table over the folders of all loads. Only footers are read to plan it."""
    schema = common_schema([spark.read.option("mergeSchema", True).parquet(folder).schema for folder in loads])
    return spark.read.schema(schema).parquet(*loads)
