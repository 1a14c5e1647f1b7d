"""Avro: a scan through the input format on Spark's class path, and a small codec for container files of metadata."""

from __future__ import annotations

import json
import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = b"Obj\x01"


def scan(spark: SparkSession, path: str, schema: T.StructType, logical_types: bool = False, real: T.StructType | None = None) -> DataFrame:
    """Records of all files below path, splittable. schema: physical types; dates and times are numbers unless logical_types."""
    sc = spark.sparkContext
    text = sc.hadoopFile(path, "org.apache.avro.mapred.AvroAsTextInputFormat", "org.apache.hadoop.io.Text", "org.apache.hadoop.io.NullWritable", conf={"mapreduce.input.fileinputformat.input.dir.recursive": "true"}).map(lambda kv: (kv[0],))
    lines = spark.createDataFrame(text, "value string")
    read = T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in schema.fields])
    found = lines.select(F.from_json("value", read).alias("r"))
    return found.select(*[_typed(F.col("r")[f.name], f.dataType, (real or schema)[f.name].dataType if logical_types else f.dataType).alias(f.name) for f in schema.fields])


def _as_text(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, T.BinaryType) else kind


def _typed(c: Column, kind: T.DataType, real: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.encode(c, "ISO-8859-1")
    if isinstance(real, T.DateType):
        return F.date_from_unix_date(c)
    if isinstance(real, (T.TimestampType, T.TimestampNTZType)) and isinstance(kind, T.LongType):
        return F.timestamp_micros(c).cast(real)
    return c


# ---------------------------------------------------------------- container files
def _long(n: int) -> bytes:
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z & ~0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    return bytes([*out, z])


class _In:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise ValueError("an Avro file is cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        shift = z = 0
        while True:
            b = self.take(1)[0]
            z |= (b & 0x7F) << shift
            if b < 128:
                return (z >> 1) ^ -(z & 1)
            shift += 7


def _names(schema, known: dict) -> None:
    if isinstance(schema, dict):
        if "name" in schema and schema.get("type") in ("record", "fixed", "enum"):
            known[schema["name"]] = schema
        for x in (schema.get("fields") or []) + [schema.get("items"), schema.get("values")]:
            _names(x["type"] if isinstance(x, dict) and "type" in x and "name" in x and x.get("type") not in ("record", "fixed", "enum") else x, known)
    elif isinstance(schema, list):
        for x in schema:
            _names(x, known)


def _decode(s: _In, schema, known: dict):
    if isinstance(schema, list):
        return _decode(s, schema[s.long()], known)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return _decode(s, kind, known)
    match kind:
        case "null":
            return None
        case "boolean":
            return s.take(1) == b"\1"
        case "int" | "long":
            return s.long()
        case "float":
            return struct.unpack("<f", s.take(4))[0]
        case "double":
            return struct.unpack("<d", s.take(8))[0]
        case "bytes":
            return s.take(s.long())
        case "string":
            return s.take(s.long()).decode()
        case "fixed":
            return s.take(schema["size"])
        case "enum":
            return schema["symbols"][s.long()]
        case "record":
            return {f["name"]: _decode(s, f["type"], known) for f in schema["fields"]}
        case "array" | "map":
            out = []
            while n := s.long():
                if n < 0:
                    n = -n
                    s.long()
                for _ in range(n):
                    out.append((_decode(s, "string", known), _decode(s, schema["values"], known)) if kind == "map" else _decode(s, schema["items"], known))
            return dict(out) if kind == "map" else out
    return _decode(s, known[kind], known)


def _encode(v, schema, known: dict) -> bytes:
    if isinstance(schema, list):
        i = next(k for k, x in enumerate(schema) if (x == "null") == (v is None))
        return _long(i) + _encode(v, schema[i], known)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return _encode(v, kind, known)
    match kind:
        case "null":
            return b""
        case "boolean":
            return b"\1" if v else b"\0"
        case "int" | "long":
            return _long(int(v))
        case "float":
            return struct.pack("<f", v)
        case "double":
            return struct.pack("<d", v)
        case "bytes":
            return _long(len(v)) + v
        case "string":
            return _long(len(v.encode())) + v.encode()
        case "fixed":
            return v
        case "enum":
            return _long(schema["symbols"].index(v))
        case "record":
            return b"".join(_encode(v.get(f["name"]), f["type"], known) for f in schema["fields"])
        case "array":
            return (_long(len(v)) + b"".join(_encode(x, schema["items"], known) for x in v) if v else b"") + _long(0)
        case "map":
            return (_long(len(v)) + b"".join(_encode(k, "string", known) + _encode(x, schema["values"], known) for k, x in v.items()) if v else b"") + _long(0)
    return _encode(v, known[kind], known)


_META = {"type": "map", "values": "bytes"}


def read_container(data: bytes) -> list[dict]:
    s = _In(data)
    if s.take(4) != MAGIC:
        raise ValueError("not an Avro file")
    meta = _decode(s, _META, {})
    schema, known, sync = json.loads(meta["avro.schema"]), {}, s.take(16)
    _names(schema, known)
    codec, out = meta.get("avro.codec", b"null"), []
    if codec not in (b"null", b"deflate"):
        raise ValueError(f"codec {codec.decode()} isn't read here")
    while s.at < len(data):
        n, block = s.long(), s.take(s.long())
        inner = _In(zlib.decompress(block, -15) if codec == b"deflate" else block)
        out += [_decode(inner, schema, known) for _ in range(n)]
        if s.take(16) != sync:
            raise ValueError("an Avro block doesn't end where it should")
    return out


_SYNC = bytes(range(16))


def header(schema: dict, deflate: bool = True) -> bytes:
    """How a container file begins; blocks follow."""
    return MAGIC + _encode({"avro.schema": json.dumps(schema).encode(), "avro.codec": b"deflate" if deflate else b"null"}, _META, {}) + _SYNC


def block(records: list[dict], schema: dict, deflate: bool = True) -> bytes:
    if not records:
        return b""
    known: dict = {}
    _names(schema, known)
    body = b"".join(_encode(r, schema, known) for r in records)
    if deflate:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(body) + c.flush()
    return _long(len(records)) + _long(len(body)) + body + _SYNC


def write_container(records: list[dict], schema: dict, deflate: bool = True) -> bytes:
    return header(schema, deflate) + block(records, schema, deflate)
