"""Codecs between values and bytes, as column expressions.

Built-in expressions are used wherever there is one; a Python function runs as
an Arrow-batched UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from streamlog.model import struct_of


@dataclass(frozen=True)
class Codec:
    """``encode`` turns a value column into bytes, ``decode`` bytes into a value column."""

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]


def string_codec(charset: str = "UTF-8") -> Codec:
    return Codec(lambda c: F.encode(c, charset), lambda c: F.decode(c, charset))


def bytes_codec() -> Codec:
    return Codec(lambda c: c.cast("binary"), lambda c: c)


def long_codec() -> Codec:
    """Eight bytes, big-endian; other lengths are an error."""
    return Codec(
        lambda c: F.unhex(F.lpad(F.hex(c.cast("long")), 16, "0")),
        lambda c: F.conv(F.hex(_of_length(c, 8)), 16, -10).cast("long"),
    )


def _of_length(c: Column, n: int) -> Column:
    wrong = F.raise_error(F.format_string(f"{n} bytes expected, got %d", F.octet_length(c))).cast("binary")
    return F.when(c.isNull() | (F.octet_length(c) == n), c).otherwise(wrong)


def fixed_length_or_error(decode: Callable[[Column], Column], n: int) -> Callable[[Column], Column]:
    """A decoder for ``encode_or_error``: bytes of another length become an error row, not a failed job."""

    def run(c: Column) -> Column:
        fits = F.octet_length(c) == n
        text = F.when(c.isNotNull() & ~fits, F.format_string(f"{n} bytes expected, got %d", F.octet_length(c)))
        return F.struct(decode(F.when(fits, c)).alias("result"), text.alias("error"))

    return run


def int_codec() -> Codec:
    """Four bytes, big-endian; other lengths are an error."""

    def decode(c: Column) -> Column:
        unsigned = F.conv(F.hex(_of_length(c, 4)), 16, 10).cast("long")
        return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")

    return Codec(lambda c: F.unhex(F.right(F.lpad(F.hex(c.cast("long")), F.lit(16), F.lit("0")), F.lit(8))), decode)


def json_codec(schema: T.StructType) -> Codec:
    return Codec(
        lambda c: F.encode(F.to_json(c), "UTF-8"),
        lambda c: F.from_json(F.decode(c, "UTF-8"), schema),
    )


def _each(function: Callable, result: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    # Arrow keeps integers and nested values as they are; pandas would turn integers with NULL into floats.
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if value is None else function(value) for value in column.to_pylist()], result)

    return run


def _data_type(kind: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(kind) if isinstance(kind, str) else kind


def function_codec(encode: Callable, decode: Callable, value_type: T.DataType | str) -> Codec:
    """Codec from two Python functions, value to bytes and bytes to value. NULL stays NULL."""
    kind = _data_type(value_type)
    return Codec(
        F.arrow_udf(_each(encode, pa.binary()), returnType=T.BinaryType()),
        F.arrow_udf(_each(decode, to_arrow_type(kind)), returnType=kind),
    )


def column_codec(
    encode: Callable[[pa.Array], pa.Array], decode: Callable[[pa.Array], pa.Array], value_type: T.DataType | str
) -> Codec:
    """Codec from two functions of whole Arrow columns."""
    return Codec(
        F.arrow_udf(encode, returnType=T.BinaryType()), F.arrow_udf(decode, returnType=_data_type(value_type))
    )


def _string_from_options(options: Mapping[str, str], is_key: bool) -> Codec:
    role = "key" if is_key else "value"
    for name in (f"{role}.serializer.encoding", "serializer.encoding"):
        if name in options:
            return string_codec(options[name])
    return string_codec()


FACTORIES: dict[str, Callable[[Mapping[str, str], bool], Codec]] = {
    "string": _string_from_options,
    "bytes": lambda options, is_key: bytes_codec(),
    "int": lambda options, is_key: int_codec(),
    "long": lambda options, is_key: long_codec(),
}


def configure(
    factory: str | Callable[[Mapping[str, str], bool], Codec],
    options: Mapping[str, str] | None = None,
    is_key: bool = False,
) -> Codec:
    """A codec set up with the source or sink options, told whether it is for keys."""
    make = FACTORIES[factory] if isinstance(factory, str) else factory
    return make(dict(options or {}), is_key)


def encode_records(records: DataFrame, key: Codec, value: Codec) -> DataFrame:
    return records.withColumns({"key": key.encode(F.col("key")), "value": value.encode(F.col("value"))})


def decode_records(records: DataFrame, key: Codec, value: Codec) -> DataFrame:
    return records.withColumns({"key": key.decode(F.col("key")), "value": value.decode(F.col("value"))})


def try_function(function: Callable, result_type: T.DataType) -> Callable[[Column], Column]:
    """A Python function whose exceptions become data: ``struct<result, error>``."""

    kind = to_arrow_type(result_type)

    def attempt(value):
        if value is None:
            return None, None
        try:
            # Building the result here makes a value of the wrong type its row's error.
            return pa.scalar(function(value), kind).as_py(), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def run(column: pa.Array) -> pa.Array:
        rows = [attempt(value) for value in column.to_pylist()]
        results, errors = pa.array([r for r, _ in rows], kind), pa.array([e for _, e in rows], pa.string())
        return pa.StructArray.from_arrays([results, errors], names=["result", "error"])

    return F.arrow_udf(run, returnType=struct_of(result=result_type, error=T.StringType()))


def encode_or_error(records: DataFrame, column: str, encode: Callable[[Column], Column]) -> DataFrame:
    """Encode one column with a ``struct<result, error>`` expression and add ``error``."""
    return (
        records.withColumn("_tried", encode(F.col(column)))
        .withColumns({column: F.col("_tried.result"), "error": F.col("_tried.error")})
        .drop("_tried")
    )


def cast_or_error(records: DataFrame, column: str, wanted: str) -> DataFrame:
    """Cast one column; what does not read as ``wanted`` gets an ``error`` instead of failing the job."""
    cast = F.col(column).try_cast(wanted)
    bad = F.col(column).isNotNull() & cast.isNull()
    return records.withColumn(
        "error", F.when(bad, F.concat(F.lit(f"not a {wanted}: "), F.col(column).cast("string")))
    ).withColumn(column, cast)


def split_failed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to write and rows to report, by their ``error`` column."""
    return records.filter(F.col("error").isNull()).drop("error"), records.filter(F.col("error").isNotNull())
