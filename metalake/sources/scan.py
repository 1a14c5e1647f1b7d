"""Tables as DataFrames, whatever their format."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths, types
from ..functions.formats import detect
from ..model import Format, TableMeta, UnsupportedFormat
from . import avro

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


# ---------------------------------------------------------------- files
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A whole small file of metadata."""
    rows = spark.read.format("binaryFile").load(path).select("content").collect()
    return bytes(rows[0]["content"])


# ---------------------------------------------------------------- formats
def _keys(meta: TableMeta) -> list[T.StructField]:
    return [T.StructField(c.name, types.parse_type(c.type)) for c in meta.partition_keys]


def _arranged(df: DataFrame, data: list[str], keys: list[str]) -> DataFrame:
    """Data columns, then partition columns by name."""
    return df.select(*data, *sorted(keys))


def scan_parquet(spark: SparkSession, meta: TableMeta, path: str) -> DataFrame:
    keys = _keys(meta)
    if not keys:
        return spark.read.parquet(path)
    names = {k.name.lower() for k in keys}
    files = spark.read.option("basePath", path).parquet(path)
    data = [f for f in files.schema.fields if f.name.lower() not in names]
    df = spark.read.schema(T.StructType([*data, *keys])).option("basePath", path).parquet(path)
    return _arranged(df, [f.name for f in data], [k.name for k in keys])


def scan_orc(spark: SparkSession, meta: TableMeta, path: str) -> DataFrame:
    keys = _keys(meta)
    data = (types.recorded_schema(meta.parameters) or types.declared_schema(meta, False)).fields
    data = [f for f in data if f.name.lower() not in {k.name.lower() for k in keys}]
    if not data:
        return spark.read.orc(path)
    return _arranged(spark.read.schema(T.StructType([*data, *keys])).orc(path), [f.name for f in data], [k.name for k in keys])


def scan_csv(spark: SparkSession, meta: TableMeta, path: str) -> DataFrame:
    """Delimited text. Rows shorter than the schema are padded; rows with a value that isn't of its column's type, or with too many
    fields, are left out. Every field is read as text and cast, so a row's fate doesn't depend on the columns asked for."""
    keys = {k.name.lower(): k for k in _keys(meta)}
    recorded = types.recorded_schema(meta.parameters)
    schema = [f for f in (recorded or types.declared_schema(meta, False)).fields if f.name.lower() not in keys]
    given = meta.serde_parameters.get("field.delim")
    by_spark = meta.parameters.get("spark.sql.sources.provider", "").lower() == "csv"
    friendly = by_spark or (recorded is not None and given not in (None, "\x01"))
    sep = meta.serde_parameters.get("delimiter") or meta.serde_parameters.get("sep") or given or ("," if by_spark else "\x01")
    if by_spark and sep == "\x01":
        sep = ","
    null_text = meta.serde_parameters.get("serialization.null.format", "")
    skip = int(meta.parameters.get("skip.header.line.count", "0") or 0)
    header = skip >= 1 or meta.serde_parameters.get("header", "").lower() == "true"
    if friendly and not header:
        quoted = lambda s: s.strip().strip('"').lower()
        head = spark.read.text(path).limit(1).collect()
        header = bool(head) and [quoted(x) for x in head[0]["value"].split(sep)] == [f.name.lower() for f in schema]
    raw = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(schema) + 1)] + list(keys.values()))
    reader = spark.read.schema(raw).option("sep", sep).option("mode", "PERMISSIVE").option("header", str(header).lower()).option("enforceSchema", "true").option("nullValue", null_text).option("emptyValue", "")
    reader = reader.option("quote", '"').option("escape", '"') if friendly else reader.option("quote", "").option("escape", "")
    df = reader.csv(path)
    cast = lambda i, f: F.col(f"_c{i}") if isinstance(f.dataType, T.StringType) else F.col(f"_c{i}").try_cast(f.dataType)
    good = F.col(f"_c{len(schema)}").isNull()
    for i, f in enumerate(schema):
        if not isinstance(f.dataType, T.StringType):
            good &= F.col(f"_c{i}").isNull() | (F.col(f"_c{i}") == "") | cast(i, f).isNotNull()
    out = df.where(good).select(*[cast(i, f).alias(f.name) for i, f in enumerate(schema)], *[k.name for k in keys.values()])
    return _arranged(out, [f.name for f in schema], [k.name for k in keys.values()])


def scan_avro(spark: SparkSession, meta: TableMeta, path: str) -> DataFrame:
    real = types.recorded_schema(meta.parameters) or types.declared_schema(meta, False)
    return avro.scan(spark, path, types.avro_physical(real))


# ---------------------------------------------------------------- Delta
SUPPORTED_READER = 1


def delta_files(spark: SparkSession, root: str) -> tuple[T.StructType, list[str], DataFrame]:
    """(schema, partition columns, live files (path, partitionValues)) of the newest version: the last checkpoint and the commits after it."""
    log = root.rstrip("/") + "/_delta_log"
    names = list_names(spark, log)
    commits = {int(n[:20]): n for n in names if n.endswith(".json") and n[:20].isdigit()}
    checkpoints: dict[int, list[str]] = {}
    for n in names:
        if ".checkpoint" in n and n.endswith(".parquet") and n[:20].isdigit():
            checkpoints.setdefault(int(n[:20]), []).append(n)
    if not commits and not checkpoints:
        raise UnsupportedFormat(f"no transaction log at {root}")
    whole = {v: found for v, found in checkpoints.items() if all(len(found) == int(n.split(".")[-2]) for n in found if n.count(".") == 4)}  # of several parts all are there
    start = max(whole, default=-1)
    newest = max(commits, default=start)
    if missing := sorted(set(range(start + 1, newest + 1)) - set(commits)):
        raise UnsupportedFormat(f"the log at {root} lacks version {missing[0]}")
    checkpoints = whole
    action = (
        "add struct<path:string,partitionValues:map<string,string>,deletionVector:struct<storageType:string>>, remove struct<path:string>,"
        " metaData struct<schemaString:string,partitionColumns:array<string>,configuration:map<string,string>>, protocol struct<minReaderVersion:int,readerFeatures:array<string>>"
    )
    parts = []
    later = [f"{log}/{commits[v]}" for v in sorted(commits) if v > start]
    if later:
        version = F.regexp_extract(F.input_file_name(), r"(\d{20})\.json$", 1).cast("long")
        parts.append(spark.read.schema(T.StructType.fromDDL(action)).json(later).withColumn("version", version))
    if start >= 0:
        files = [f"{log}/{n}" for n in checkpoints[start]]
        have = {f.name for f in spark.read.parquet(*files).schema.fields}
        df = spark.read.schema(T.StructType([f for f in T.StructType.fromDDL(action).fields if f.name in have])).parquet(*files)
        for f in T.StructType.fromDDL(action).fields:
            if f.name not in have:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        parts.append(df.select("add", "remove", "metaData", "protocol").withColumn("version", F.lit(start).cast("long")))
    actions = parts[0] if len(parts) == 1 else parts[0].select("add", "remove", "metaData", "protocol", "version").unionByName(parts[1])
    last = actions.agg(F.max_by("metaData", F.when(F.col("metaData").isNotNull(), F.col("version"))).alias("m"), F.max_by("protocol", F.when(F.col("protocol").isNotNull(), F.col("version"))).alias("p")).first()
    meta, protocol = last["m"], last["p"]
    if meta is None:
        raise UnsupportedFormat(f"the log at {root} has no metadata")
    if protocol and ((protocol["minReaderVersion"] or 1) > 3 or set(protocol["readerFeatures"] or ()) - {"timestampNtz", "appendOnly", "invariants"}):
        raise UnsupportedFormat(f"{root} needs reader features that aren't read here: {protocol['readerFeatures']}")
    if (meta["configuration"] or {}).get("delta.columnMapping.mode", "none") != "none":
        raise UnsupportedFormat(f"{root} maps its columns, which isn't read here")
    path = F.coalesce("add.path", "remove.path")
    # of one path the last action counts; within a commit an add comes after a remove
    live = actions.where(path.isNotNull()).groupBy(path.alias("path")).agg(F.max_by("add", F.struct("version", F.col("add").isNotNull())).alias("add")).where("add is not null")
    schema = types._from_json(json.loads(meta["schemaString"]))
    return schema, list(meta["partitionColumns"] or []), live.select("path", F.col("add.partitionValues").alias("values"), F.col("add.deletionVector").isNotNull().alias("dv"))


def scan_delta(spark: SparkSession, meta: TableMeta, path: str) -> DataFrame:
    schema, keys, live = delta_files(spark, path)
    root = path.rstrip("/")
    files = live.collect()  # a row a file, as for any file listing
    if any(f["dv"] for f in files):
        raise UnsupportedFormat(f"{path} has deletion vectors, which aren't read here")
    from urllib.parse import unquote

    full = lambda p: unquote(p) if "://" in p or p.startswith("/") else f"{root}/{unquote(p)}"
    names = [f.name for f in schema.fields]
    if not files:
        return spark.createDataFrame([], schema)
    if not keys:
        return spark.read.schema(schema).parquet(*[full(f["path"]) for f in files]).select(*names)
    inside = all("://" not in f["path"] and not f["path"].startswith("/") and all(f"{k}=" in f["path"] for k in keys) for f in files)
    if inside:  # directories carry the values: Spark prunes them
        return spark.read.schema(schema).option("basePath", root).parquet(*[full(f["path"]) for f in files]).select(*names)
    groups: dict[tuple, list[str]] = {}
    for f in files:
        groups.setdefault(tuple((f["values"] or {}).get(k) for k in keys), []).append(full(f["path"]))
    data = T.StructType([f for f in schema.fields if f.name not in keys])
    parts = []
    for values, found in groups.items():
        df = spark.read.schema(data).parquet(*found)
        for k, v in zip(keys, values, strict=True):
            df = df.withColumn(k, F.lit(v).cast(schema[k].dataType))
        parts.append(df.select(*names))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


# ---------------------------------------------------------------- Iceberg
def _iceberg_type(kind) -> T.DataType:
    if isinstance(kind, dict):
        if kind["type"] == "struct":
            return T.StructType([T.StructField(f["name"], _iceberg_type(f["type"]), metadata={"parquet.field.id": f["id"]} if "id" in f else {}) for f in kind["fields"]])
        if kind["type"] == "list":
            return T.ArrayType(_iceberg_type(kind["element"]))
        return T.MapType(_iceberg_type(kind["key"]), _iceberg_type(kind["value"]))
    if kind.startswith("fixed") or kind == "binary":
        return T.BinaryType()
    extra = {"timestamptz": T.TimestampType(), "uuid": T.StringType(), "time": T.LongType()}
    return extra.get(kind) or types.parse_type(kind)


def _places(kind, path: tuple[str, ...] = ()) -> list[tuple[int, tuple[str, ...]]]:
    """(field id, path of names) of each field of a type, nested ones too."""
    if not isinstance(kind, dict):
        return []
    if kind["type"] == "struct":
        return [x for f in kind["fields"] for x in [(f.get("id", -1), (*path, f["name"])), *_places(f["type"], (*path, f["name"]))]]
    return [x for part in ("element", "key", "value") if part in kind for x in _places(kind[part], (*path, part))]


def moved_fields(schemas: list[dict]) -> bool:
    """Whether a field has had another name, or a name another field, in any of a table's schemas."""
    seen = {x for s in schemas for x in _places(s)}
    return len({i for i, _ in seen}) < len(seen) or len({p for _, p in seen}) < len(seen)


def without_ids(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, without_ids(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(without_ids(kind.elementType), kind.containsNull)
    return T.MapType(without_ids(kind.keyType), without_ids(kind.valueType)) if isinstance(kind, T.MapType) else kind


def iceberg_metadata(spark: SparkSession, meta: TableMeta, root: str, guess: bool = True) -> str:
    """The metadata file: that which the catalog names, else the highest version in the table's folder."""
    named = meta.parameters.get("metadata_location")
    if named:
        return paths.to_hadoop(named)
    if not guess:
        raise UnsupportedFormat(f"{root}: the catalog names no metadata file, and guessing versions is off")
    names = [n for n in list_names(spark, root + "/metadata") if n.endswith(".metadata.json")]
    version = lambda n: int("".join(ch for ch in n.split(".")[0].split("-")[0] if ch.isdigit()) or -1)
    if not names:
        raise UnsupportedFormat(f"no metadata at {root}")
    return f"{root}/metadata/{max(names, key=lambda n: (version(n), n))}"


def scan_iceberg(spark: SparkSession, meta: TableMeta, path: str, guess: bool = True) -> DataFrame:
    info = json.loads(read_bytes(spark, iceberg_metadata(spark, meta, path, guess)))
    schemas = {s.get("schema-id", 0): s for s in info.get("schemas") or [info["schema"]]}
    by_id = _iceberg_type(schemas[info.get("current-schema-id", max(schemas))])
    schema = without_ids(by_id)
    current = info.get("current-snapshot-id")
    snapshot = next((s for s in info.get("snapshots") or [] if s["snapshot-id"] == current), None)
    if snapshot is None or current == -1:
        return spark.createDataFrame([], schema)
    old = info["location"].rstrip("/")
    bare = lambda p: p.removeprefix("file://").removeprefix("file:")

    def here(p: str) -> str:
        """A recorded path below the table's present root."""
        return path + bare(p)[len(bare(old)) :] if bare(p).startswith(bare(old) + "/") else paths.to_hadoop(p)

    listed = "manifest-list" in snapshot  # version 1 may hold the manifests' paths themselves
    manifests = avro.read_container(read_bytes(spark, here(snapshot["manifest-list"]))) if listed else [{"manifest_path": m} for m in snapshot.get("manifests", [])]
    if any(m.get("content", 0) == 1 for m in manifests):
        raise UnsupportedFormat(f"{path} has delete files, which aren't read here")
    places = [here(m["manifest_path"]) for m in manifests]
    if not places:
        return spark.createDataFrame([], schema)
    # manifests are read where they lie: a task each
    found = spark.read.format("binaryFile").load(places).select("content").rdd.flatMap(
        lambda r: [(e["data_file"]["file_path"], e["data_file"]["file_format"]) for e in avro.read_container(bytes(r[0])) if e["status"] != 2]
    ).collect()
    if any(f.upper() != "PARQUET" for _, f in found):
        raise UnsupportedFormat(f"{path} has data files other than Parquet")
    if not found:
        return spark.createDataFrame([], schema)
    files = [here(p) for p, _ in found]
    if not moved_fields(list(schemas.values())):
        return spark.read.schema(schema).parquet(*files)
    # columns by their ids, as names have moved; Spark has no option for this but the session's. A file without ids is an error then, not nulls
    spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
    return spark.read.schema(by_id).parquet(*files)


READERS: dict[Format, Callable[[SparkSession, TableMeta, str], DataFrame]] = {
    Format.PARQUET: scan_parquet,
    Format.CSV: scan_csv,
    Format.AVRO: scan_avro,
    Format.ORC: scan_orc,
    Format.DELTA: scan_delta,
    Format.ICEBERG: scan_iceberg,
}


def read(spark: SparkSession, meta: TableMeta) -> DataFrame:
    """The table as a DataFrame; nothing but metadata is read before an action."""
    if meta.table_type == "VIRTUAL_VIEW":
        raise UnsupportedFormat(f"{meta.database}.{meta.name} is a view of another engine")
    kind = detect(meta)
    if kind not in READERS:
        raise UnsupportedFormat(f"unsupported format of {meta.database}.{meta.name}: {meta.input_format} / {meta.serde}")
    if (found := paths.endpoint_of(paths.strip_placeholder(meta.location))) is not None:
        conf = spark._jsc.hadoopConfiguration()
        for k, v in paths.s3_options(*found).items():
            conf.set(k, v)
    return READERS[kind](spark, meta, paths.normalise(meta, kind))
