import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.functions import serde
from streamlog.model import struct_of


def through(codec, df, column="v"):
    return rows(df.select(codec.decode(codec.encode(F.col(column)))))


def test_string_codecs(spark):
    texts = spark.createDataFrame([("foo",), ("grün",), ("",), (None,)], "v string")
    for charset in ("UTF-8", "UTF-16BE"):
        assert through(serde.string_codec(charset), texts) == rows(texts)


@pytest.mark.parametrize("name, bits", [("int", 31), ("long", 63)])
def test_number_codecs_are_big_endian(spark, name, bits):
    values = [0, 1, -1, 2**bits - 1, -(2**bits), 123456, None]
    data = spark.createDataFrame([(v,) for v in values], f"v {name}")
    codec = serde.configure(name)
    assert through(codec, data) == rows(data)
    assert [r[0] for r in data.select(codec.encode(F.col("v"))).collect()] == [
        None if v is None else v.to_bytes((bits + 1) // 8, "big", signed=True) for v in values
    ]


def test_json_codec(spark):
    schema = struct_of(k=T.LongType(), s=T.StringType())
    data = spark.createDataFrame([((1, "a"),), (None,)], "v struct<k:long,s:string>")
    assert through(serde.json_codec(schema), data) == rows(data)


def test_function_codec(spark):
    data = spark.createDataFrame([("foo",), (None,), ("bar",)], "v string")
    codec = serde.function_codec(lambda s: s.encode(), lambda b: b.decode() + "!", "string")
    assert through(codec, data) == [(None,), ("bar!",), ("foo!",)]


def test_codecs_see_their_options_and_role(spark):
    seen = []

    def factory(options, is_key):
        seen.append((options["mock.config"], is_key))
        return serde.string_codec()

    for is_key in (True, False):
        serde.configure(factory, {"mock.config": "mock_value"}, is_key)
    assert seen == [("mock_value", True), ("mock_value", False)]
    options = {"key.serializer.encoding": "UTF-16BE"}
    data = spark.createDataFrame([("a", "a")], "key string, value string")
    coded = serde.encode_records(data, serde.configure("string", options, True), serde.configure("string", options, False))
    assert coded.first().asDict() == {"key": b"\x00a", "value": b"a"}
    back = serde.decode_records(coded, serde.configure("string", options, True), serde.configure("string", options))
    assert rows(back) == [("a", "a")]


def test_a_failing_encode_fails_its_record_only(spark):
    def picky(text):
        if text == "bad":
            raise ValueError("no bad ones")
        return text.encode()

    data = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "i int, value string")
    tried = serde.encode_or_error(data, "value", serde.try_function(picky, T.BinaryType()))
    good, failed = serde.split_failed(tried)
    assert rows(good) == [(1, b"good"), (3, None)]
    assert rows(failed) == [(2, None, "ValueError: no bad ones")]


def test_a_failing_cast_is_reported(spark):
    data = spark.createDataFrame([("1",), ("x",), (None,)], "value string")
    assert rows(serde.cast_or_error(data, "value", "int")) == [(None, None), (None, "not a int: x"), (1, None)]
