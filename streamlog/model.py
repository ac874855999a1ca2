"""Table layouts shared by every operator.

An *offset* in an offsets table is always the next one to read, so a partition
whose last record has offset 41 stands at 42.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

def struct_of(**columns: T.DataType) -> T.StructType:
    """A schema from ``name=type`` pairs; needs no running session."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _INT, _LONG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()

LOG_SCHEMA = struct_of(
    topic=_STRING, partition=_INT, offset=_LONG, timestamp=_TIME, key=_STRING, value=_STRING
)
OFFSETS_SCHEMA = struct_of(topic=_STRING, partition=_INT, offset=_LONG)
COMMITS_SCHEMA = struct_of(
    group_id=_STRING, topic=_STRING, partition=_INT, offset=_LONG, committed_at=_TIME
)
ACKS_SCHEMA = struct_of(
    batch_id=_LONG, topic=_STRING, partition=_INT, offset=_LONG, status=_STRING, error=_STRING
)

TOPIC_PARTITION = ["topic", "partition"]


class TopicPartition(NamedTuple):
    topic: str
    partition: int


class SchemaMismatch(TypeError):
    """The columns of a DataFrame are not exactly the expected ones."""


def _shape(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(field.name, field.dataType) for field in schema.fields]


def has_schema(df: DataFrame, schema: T.StructType) -> bool:
    """Whether names, order and types are exactly those of ``schema`` (nullability aside)."""
    return _shape(df.schema) == _shape(schema)


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if it has exactly this schema, else raise."""
    if not has_schema(df, schema):
        raise SchemaMismatch(f"expected {schema.simpleString()}, got {df.schema.simpleString()}")
    return df


def match_schema(df: DataFrame, *cases):
    """Apply the function of the first ``(schema, function)`` case that fits; None if none does."""
    for schema, function in cases:
        if has_schema(df, schema):
            return function(df)
    return None
