"""Projections of consumed records and construction of output records.

Output records have the columns ``topic, partition, timestamp, key, value``; a
NULL partition leaves the choice to the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTPUT_COLUMNS = ["topic", "partition", "timestamp", "key", "value"]


def pairs(records: DataFrame) -> DataFrame:
    """Keys and values; a missing key stays NULL."""
    return records.select("key", "value")


def values(records: DataFrame) -> DataFrame:
    return records.select("value")


def size(records: DataFrame) -> DataFrame:
    """One row with the number of records."""
    return records.agg(F.count(F.lit(1)).alias("n"))


def from_values(values: DataFrame, topic: str, partition: int) -> DataFrame:
    """Values of one topic partition as unnumbered keyless records."""
    return from_pairs(values.select(F.lit(None).cast("string").alias("key"), "*"), topic, partition)


def from_pairs(pairs: DataFrame, topic: str, partition: int) -> DataFrame:
    """Pairs of one topic partition as unnumbered records; other columns are kept for ordering."""
    return pairs.select(F.lit(topic).alias("topic"), F.lit(partition).cast("int").alias("partition"), "*")


def from_map(
    spark: SparkSession,
    partitions: Mapping[tuple[str, int], Sequence[tuple]],
    key_type: str = "string",
    value_type: str = "string",
) -> DataFrame:
    """Records from ``{(topic, partition): [(key, value), ...]}``, for tests; offsets are list positions."""
    data = [
        (topic, partition, offset, key, value)
        for (topic, partition), pairs in partitions.items()
        for offset, (key, value) in enumerate(pairs)
    ]
    return spark.createDataFrame(
        data, f"topic string, partition int, offset bigint, key {key_type}, value {value_type}"
    )


def _as_column(topic: str | Column) -> Column:
    return F.lit(topic) if isinstance(topic, str) else topic


def to_producer_records(records: DataFrame, topic: str | Column) -> DataFrame:
    """Re-address records to ``topic``, keeping key and value only."""
    return records.select(_as_column(topic).alias("topic"), "key", "value")


def values_to_producer_records(records: DataFrame, topic: str | Column) -> DataFrame:
    """Re-address records to ``topic`` without their keys."""
    return records.select(
        _as_column(topic).alias("topic"), F.lit(None).cast("string").alias("key"), "value"
    )


def values_with_key(records: DataFrame, topic: str | Column, key: str | Column) -> DataFrame:
    """Re-address records to ``topic`` under one key (or a key expression)."""
    return records.select(_as_column(topic).alias("topic"), _as_column(key).alias("key"), "value")


def with_destination(
    records: DataFrame,
    topic: str | Column,
    partition: int | Column | None = None,
    timestamp: Column | None = None,
    key: str | Column | None = None,
    value: str | Column = "value",
) -> DataFrame:
    """Output records with every field given; None for a field means it is not set."""
    partition = partition if isinstance(partition, Column) else F.lit(partition)
    key = F.lit(None).cast("string") if key is None else F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    timestamp = F.lit(None).cast("timestamp") if timestamp is None else timestamp
    return records.select(
        _as_column(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        timestamp.alias("timestamp"),
        key.alias("key"),
        value.alias("value"),
    )


def complete_output(records: DataFrame) -> DataFrame:
    """Fill in the optional output columns that are missing."""
    missing = {
        "partition": F.lit(None).cast("int"),
        "timestamp": F.lit(None).cast("timestamp"),
        "key": F.lit(None).cast("string"),
    }
    return records.select(
        *[
            F.col(name) if name in records.columns else missing[name].alias(name)
            for name in OUTPUT_COLUMNS
        ]
    )


def map_records(records: DataFrame, accepts: Column, to_output: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Write only what ``accepts`` holds for, mapped by ``to_output``; the rest is left out."""
    return records.filter(accepts).transform(to_output)


def typed(records: DataFrame, key_type: str | None = None, value_type: str | None = None) -> DataFrame:
    """Keep the records whose key and value both read as the given types, and cast them."""
    kept = records
    for name, wanted in (("key", key_type), ("value", value_type)):
        if wanted is not None:
            kept = kept.filter(F.col(name).try_cast(wanted).isNotNull()).withColumn(
                name, F.col(name).try_cast(wanted)
            )
    return kept


def _leaf(kind: T.DataType) -> str:
    """Pattern of the types a JSON value may have for a column of this type."""
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    if isinstance(kind, T.NumericType):
        return "BIGINT|DOUBLE|DECIMAL.*"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, T.StringType):
        return "STRING"
    raise TypeError(f"no JSON value has the type {kind.simpleString()}")


def payload_matches(value: Column, kind: T.DataType, nullable: bool = True) -> Column:
    """Whether a VARIANT has exactly this type: every field there, none more, each of its own type.

    Null is allowed where the type says so; whole numbers also read as fractional ones.
    """
    shape = F.schema_of_variant(value)
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        fits = F.sort_array(F.map_keys(fields)) == F.array(*[F.lit(name) for name in sorted(kind.names)])
        for field in kind.fields:
            fits = fits & payload_matches(F.element_at(fields, F.lit(field.name)), field.dataType, field.nullable)
    elif isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        fits = F.forall(items, lambda item: payload_matches(item, kind.elementType, kind.containsNull))
    else:
        fits = shape.rlike(f"^({_leaf(kind)})$") & F.try_variant_get(value, "$", kind.simpleString()).isNotNull()
    fits = F.coalesce(fits, F.lit(False))
    return fits | F.coalesce(shape == "VOID", F.lit(False)) if nullable else fits


def typed_payloads(records: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Keep the records whose JSON payload has exactly the type ``schema``, nested fields included, read as it.

    Records of several kinds may share a topic: what is not JSON, lacks a
    field, has one more or another type doesn't match.
    """
    parsed = records.withColumn("_payload", F.try_parse_json(F.col(column)))
    kept = parsed.filter(payload_matches(F.col("_payload"), schema, nullable=False))
    return kept.withColumn(column, F.try_variant_get("_payload", "$", schema.simpleString())).drop("_payload")


def dedup(records: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """One copy per key, with all its columns; if copies differ the greatest value wins, then
    the other columns in their order, so a rerun agrees.

    Copies are folded before the shuffle, so a record sent very often costs
    one row per task.
    """
    others = [value, *(c for c in records.columns if c not in (*keys, value))]
    folded = records.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_copy"))
    return folded.select(*keys, "_copy.*").select(*records.columns)


def read_committed(records: DataFrame, transaction: str, aborted: DataFrame) -> DataFrame:
    """Hide the records whose transaction is listed in ``aborted``.

    ``aborted`` may repeat transactions. A broadcast is left to the planner;
    beyond its size limit AQE splits a hot transaction on the record side.
    """
    return records.join(aborted.select(transaction).distinct(), transaction, "left_anti")


class TooFewRecords(RuntimeError):
    """A bounded read ended with fewer records than required."""


def expect_at_least(records: DataFrame, expected: int) -> DataFrame:
    """Return ``records`` whole if there are at least ``expected``, else raise."""
    found = records.count()
    if found < expected:
        raise TooFewRecords(f"expected {expected} records but got {found}")
    return records
