import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from metalake.functions import formats, paths, types
from metalake.model import Format, InvalidInput, TableMeta, UnsupportedType
from metalake.sources import avro
from metalake.sources.metastore import parse_endpoint

SIMPLE = st.sampled_from([T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.BinaryType(), T.DateType(), T.DecimalType(10, 2), T.DecimalType(38, 0)])
TYPES = st.recursive(SIMPLE, lambda t: st.one_of(t.map(T.ArrayType), st.tuples(SIMPLE, t).map(lambda p: T.MapType(*p)), st.lists(t, min_size=1, max_size=3).map(lambda ts: T.StructType([T.StructField(f"f{i}", x) for i, x in enumerate(ts)]))), max_leaves=6)


@given(TYPES)
def test_types_round_trip(kind):
    assert types.parse_type(types.to_catalog_type(kind)) == kind


@pytest.mark.parametrize("text", ["interval", "uniontype<int>", "map<int>", "struct<>", "decimal(10,x)", "array<", "timestamp with local time zone"])
def test_types_refused(text):
    with pytest.raises(UnsupportedType):
        types.parse_type(text)


def test_recorded_schema():
    s = T.StructType([T.StructField("a", T.DecimalType(10, 2)), T.StructField("b", T.ShortType()), T.StructField("c", T.ArrayType(T.MapType(T.StringType(), T.LongType())))])
    whole = s.json()
    assert types.recorded_schema({"spark.sql.sources.schema": whole}) == s
    cut = [whole[:40], whole[40:90], whole[90:]]
    p = {"spark.sql.sources.schema.numParts": "3", **{f"spark.sql.sources.schema.part.{i}": c for i, c in enumerate(cut)}}
    assert types.recorded_schema(p) == s
    for bad in ("0", "1001", "x", "4"):
        assert types.recorded_schema(p | {"spark.sql.sources.schema.numParts": bad}) is None
    odd = '{"type":"struct","fields":[{"name":"u","type":{"type":"udt"}},{"type":"int"},7]}'
    assert types.recorded_schema({"spark.sql.sources.schema": odd}) == T.StructType([T.StructField("u", T.StringType())])


def test_avro_physical_and_names():
    s = T.StructType([T.StructField("d", T.DateType()), T.StructField("t", T.ArrayType(T.TimestampNTZType()))])
    assert types.avro_physical(s).simpleString() == "struct<d:int,t:array<bigint>>"
    assert types.display_name(T.MapType(T.StringType(), T.DecimalType(5, 1))) == "MAP(VARCHAR, DECIMAL(5,1))"


def test_paths():
    assert paths.endpoint_of("http://h:9000/b/k") == ("b", "h:9000") and paths.endpoint_of("https://h/b") is None and paths.endpoint_of("http://s3.amazonaws.com/b/k") is None
    assert paths.has_extension("/a.b/c") is False and paths.has_extension("/a/c.parquet")
    assert paths.glob("/t", Format.PARQUET, True) == "/t/**/*.parquet" and paths.glob("/t", Format.CSV, False) == "/t/[!_]*" and paths.glob("/t", Format.DELTA, True) == "/t"
    assert paths.s3_options("b", "h:9")["fs.s3a.bucket.b.path.style.access"] == "true"


@pytest.mark.parametrize("uri", ["", "h:x", "h:1:2", "http://h:1", ":1", "h:0"])
def test_endpoint_refused(uri):
    with pytest.raises(InvalidInput):
        parse_endpoint(uri)


def test_detection_order():
    assert formats.detect(TableMeta("t", "d", parameters={"spark.sql.sources.provider": "delta", "table_type": "ICEBERG"})) is Format.DELTA
    assert formats.detect(TableMeta("t", "d")) is Format.UNKNOWN


SCHEMA = {"type": "record", "name": "r", "fields": [{"name": "a", "type": ["null", "long"]}, {"name": "b", "type": "bytes"}, {"name": "c", "type": {"type": "array", "items": "string"}}, {"name": "d", "type": {"type": "map", "values": "double"}}]}


@given(st.lists(st.fixed_dictionaries({"a": st.none() | st.integers(-(2**63), 2**63 - 1), "b": st.binary(max_size=20), "c": st.lists(st.text(max_size=5), max_size=3), "d": st.dictionaries(st.text(max_size=3), st.floats(allow_nan=False), max_size=3)}), max_size=5), st.booleans())
def test_avro_round_trip(rows, deflate):
    assert avro.read_container(avro.write_container(rows, SCHEMA, deflate)) == rows
