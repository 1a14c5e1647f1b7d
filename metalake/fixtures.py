"""A lake of every storage format, written from the driver's Parquet tables and registered in a catalog in memory."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .engine import Engine
from .functions import types
from .model import ColumnMeta, TableMeta
from .plans.ddl import CLASSES
from .sources import avro
from .sources.metastore import MemoryMetastore

# Class names of further storage descriptors.
AVRO = ("org.apache.hadoop.hive.ql.io.avro.AvroContainerInputFormat", "org.apache.hadoop.hive.ql.io.avro.AvroContainerOutputFormat", "org.apache.hadoop.hive.serde2.avro.AvroSerDe")
ORC = ("org.apache.hadoop.hive.ql.io.orc.OrcInputFormat", "org.apache.hadoop.hive.ql.io.orc.OrcOutputFormat", "org.apache.hadoop.hive.ql.io.orc.OrcSerde")
ICEBERG = ("org.apache.iceberg.mr.hive.HiveIcebergInputFormat", "org.apache.iceberg.mr.hive.HiveIcebergOutputFormat", "org.apache.iceberg.mr.hive.HiveIcebergSerDe")
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
_built: dict[tuple[str, str], Engine] = {}


def _columns(schema: T.StructType, without: tuple[str, ...] = ()) -> tuple[ColumnMeta, ...]:
    return tuple(ColumnMeta(f.name, types.to_catalog_type(f.dataType)) for f in schema.fields if f.name not in without)


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a small file through Hadoop's file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(data))
    out.close()


def _parquet_files(spark: SparkSession, folder: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))


def write_avro(df: DataFrame, schema: dict, folder: str) -> None:
    """df's rows as an Avro file for each partition, a block for each batch, written by the executors; no row comes to the driver."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop = p.getFileSystem(spark._jsc.hadoopConfiguration())
    hadoop.mkdirs(p)
    uri = hadoop.makeQualified(p).toUri().toString().replace("s3a://", "s3://", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, place = fs.FileSystem.from_uri(uri)
        temp = f"{place}/_{uuid.uuid4().hex}"  # readers pass over such names
        with store.open_output_stream(temp) as out:
            out.write(avro.header(schema))
            for b in batches:
                out.write(avro.block(b.to_pylist(), schema))
        store.move(temp, f"{place}/part-{TaskContext.get().partitionId():05d}.avro")
        yield from ()

    df.mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def write_delta(spark: SparkSession, versions: list[tuple[list[DataFrame], list[int]]], root: str, checkpoint: int | None = None) -> None:
    """A Delta table: for each version the frames it adds and the numbers (in order of adding) of those it removes."""
    names: list[str] = []
    actions: list[dict] = []
    for v, (adds, removes) in enumerate(versions):
        log: list[dict] = []
        if v == 0:
            fields = json.loads(adds[0].schema.json())
            log += [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}}, {"metaData": {"id": "t", "format": {"provider": "parquet"}, "schemaString": json.dumps(fields), "partitionColumns": [], "configuration": {}}}]
        log += [{"remove": {"path": names[i], "dataChange": True}} for i in removes]
        for df in adds:
            before = set(_parquet_files(spark, root)) if names else set()
            df.coalesce(1).write.mode("append").parquet(root)
            name = next(n for n in _parquet_files(spark, root) if n not in before)
            names.append(name)
            log.append({"add": {"path": name, "partitionValues": {}, "size": 1, "modificationTime": 0, "dataChange": True}})
        _put(spark, f"{root}/_delta_log/{v:020d}.json", "\n".join(map(json.dumps, log)).encode())
        actions += log
        if v == checkpoint:
            gone = {a["remove"]["path"] for a in actions if "remove" in a}
            kept = [a for a in actions if "remove" not in a and a.get("add", {}).get("path") not in gone]
            schema = "add struct<path:string,partitionValues:map<string,string>>, metaData struct<schemaString:string,partitionColumns:array<string>,configuration:map<string,string>>, protocol struct<minReaderVersion:int>"
            spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(a) for a in kept], 1)).coalesce(1).write.parquet(f"{root}/_tmp")
            p = spark._jvm.org.apache.hadoop.fs.Path
            fs = p(root).getFileSystem(spark._jsc.hadoopConfiguration())
            fs.rename(p(f"{root}/_tmp/{_parquet_files(spark, f'{root}/_tmp')[0]}"), p(f"{root}/_delta_log/{v:020d}.checkpoint.parquet"))
            for old in range(v + 1):
                fs.delete(p(f"{root}/_delta_log/{old:020d}.json"), False)


MANIFEST = {"type": "record", "name": "manifest_entry", "fields": [
    {"name": "status", "type": "int"}, {"name": "snapshot_id", "type": ["null", "long"]},
    {"name": "data_file", "type": {"type": "record", "name": "r2", "fields": [{"name": "content", "type": "int"}, {"name": "file_path", "type": "string"}, {"name": "file_format", "type": "string"}, {"name": "record_count", "type": "long"}]}},
]}
MANIFEST_LIST = {"type": "record", "name": "manifest_file", "fields": [{"name": "manifest_path", "type": "string"}, {"name": "manifest_length", "type": "long"}, {"name": "content", "type": "int"}]}


def write_iceberg(spark: SparkSession, snapshots: list[DataFrame], root: str, recorded_root: str | None = None, renames: dict[str, str] | None = None) -> str:
    """An Iceberg table that adds a frame in each snapshot, its paths recorded under another root if given; the metadata file's path.

    renames: new names of columns since; the files then hold their fields' ids.
    """
    said, manifests, made = recorded_root or root, [], []
    simple = {"bigint": "long", "int": "int", "string": "string", "double": "double", "date": "date"}
    fields = [{"id": i + 1, "name": f.name, "required": False, "type": simple[f.dataType.simpleString()]} for i, f in enumerate(snapshots[0].schema.fields)]
    schemas = [{"schema-id": 0, "type": "struct", "fields": fields}]
    if renames:
        schemas.append({"schema-id": 1, "type": "struct", "fields": [f | {"name": renames.get(f["name"], f["name"])} for f in fields]})
    for k, df in enumerate(snapshots, 1):
        if renames is not None:
            df = df.select(*[F.col(f["name"]).alias(f["name"], metadata={"parquet.field.id": f["id"]}) for f in fields])
        df.coalesce(1).write.parquet(f"{root}/data/s{k}")
        entries = [{"status": 1, "snapshot_id": k, "data_file": {"content": 0, "file_path": f"{said}/data/s{k}/{n}", "file_format": "PARQUET", "record_count": 1}} for n in _parquet_files(spark, f"{root}/data/s{k}")]
        _put(spark, f"{root}/metadata/m{k}.avro", avro.write_container(entries, MANIFEST))
        manifests.append({"manifest_path": f"{said}/metadata/m{k}.avro", "manifest_length": 1, "content": 0})
        _put(spark, f"{root}/metadata/snap-{k}.avro", avro.write_container(manifests, MANIFEST_LIST, deflate=False))
        made.append({"snapshot-id": k, "manifest-list": f"{said}/metadata/snap-{k}.avro"})
        info = {"format-version": 2, "location": said, "current-schema-id": len(schemas) - 1, "schemas": schemas, "current-snapshot-id": k, "snapshots": list(made)}
        _put(spark, f"{root}/metadata/v{k}.metadata.json", json.dumps(info).encode())
    return f"{root}/metadata/v{len(snapshots)}.metadata.json"


def lake(spark: SparkSession, sf_dir: str) -> Engine:
    """The engine over a lake of this directory's tables; built once in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _built:
        return _built[key]
    store = MemoryMetastore(["default", "lake", "sf"])
    for name in SOURCES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        store.create_table(TableMeta(name, "sf", f"{sf_dir}/{name}.parquet", *CLASSES["parquet"], columns=_columns(df.schema)))
    engine = Engine(spark)
    engine.attach("thrift://memory:9083", "hms", "sf", store=store)
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="metalake-")
    engine.root = f"{shared.rstrip('/')}/lake-{uuid.uuid4().hex}"
    engine.store = store
    _built[key] = engine
    return engine


def ensure(engine: Engine, name: str) -> Engine:
    """Writes and registers a table of database lake when it is first asked for."""
    store: MemoryMetastore = engine.store
    if name in store.tables("lake"):
        return engine
    spark, at = engine.spark, f"{engine.root}/{name}"
    src = lambda n: engine.table(f"hms.sf.{n}")
    add = lambda **k: store.create_table(TableMeta(name, "lake", **{"location": at, **k}))
    described = lambda c: dict(zip(("input_format", "output_format", "serde"), c, strict=True))
    parquet, text = described(CLASSES["parquet"]), described(CLASSES["csv"])
    match name:
        case "lineitem_part":
            df = src("lineitem")
            keys = ("l_returnflag", "l_linestatus")
            df.repartition(*keys).write.partitionBy(*keys).parquet(at)
            add(**parquet, columns=_columns(df.schema, keys), partition_keys=tuple(ColumnMeta(k, "string") for k in keys))
        case "orders_decimal":
            df = src("orders").withColumn("bucket", ((F.col("o_orderkey") % 7) + F.lit(0.5)).cast("decimal(10,2)"))
            df.repartition("bucket").write.partitionBy("bucket").parquet(at)
            add(**parquet, columns=_columns(df.schema, ("bucket",)), partition_keys=(ColumnMeta("bucket", "decimal(10,2)"),))
        case "orders_multi":
            df = src("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.col("o_orderstatus").alias("status"))
            keys = ("year", "month", "status")
            df.repartition(*keys).write.partitionBy(*keys).parquet(at)
            add(**parquet, columns=_columns(df.schema, keys), partition_keys=(ColumnMeta("year", "int"), ColumnMeta("month", "int"), ColumnMeta("status", "string")))
        case "customer_text":
            df = src("customer")
            df.write.option("sep", "\x01").option("quote", "").option("escape", "").csv(at)
            add(**text, columns=_columns(df.schema))
        case "part_csv":
            df = src("part")
            df.write.option("header", "true").csv(at)
            add(**text, serde_parameters={"field.delim": ","}, parameters={"skip.header.line.count": "1", "spark.sql.sources.schema": df.schema.json()}, columns=_columns(df.schema))
        case "supplier_tolerant":
            df = src("supplier")
            good = df.select(F.concat_ws(",", *df.columns).alias("value"), "s_suppkey")
            lines = good.select(F.when(F.col("s_suppkey") % 10 == 3, F.concat(F.lit("x"), "value")).when(F.col("s_suppkey") % 10 == 5, F.concat("value", F.lit(",more"))).when(F.col("s_suppkey") % 10 == 7, F.col("s_suppkey").cast("string")).otherwise(F.col("value")).alias("value"))
            lines.write.text(at)
            add(**text, serde_parameters={"field.delim": ","}, columns=_columns(df.schema))
        case "events_avro":
            df = src("events").select("event_id", F.expr("unix_micros(cast(ts as timestamp))").alias("ts"), "user_id", "event_type", "value", F.date_diff("ts", F.lit("1970-01-01")).alias("day"))
            schema = {"type": "record", "name": "event", "fields": [
                {"name": "event_id", "type": "long"}, {"name": "ts", "type": ["null", {"type": "long", "logicalType": "timestamp-micros"}]}, {"name": "user_id", "type": ["null", "long"]},
                {"name": "event_type", "type": ["null", "string"]}, {"name": "value", "type": ["null", "double"]}, {"name": "day", "type": ["null", {"type": "int", "logicalType": "date"}]},
            ]}
            write_avro(df, schema, at)
            add(**described(AVRO), columns=(ColumnMeta("event_id", "bigint"), ColumnMeta("ts", "timestamp"), ColumnMeta("user_id", "bigint"), ColumnMeta("event_type", "string"), ColumnMeta("value", "double"), ColumnMeta("day", "date")))
        case "orders_delta" | "orders_delta_checkpoint":
            df = src("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
            third = lambda k: df.where(F.col("o_orderkey") % 3 == k)
            write_delta(spark, [([third(0), third(1)], []), ([third(2)], [0]), ([third(0).where("o_orderkey % 2 = 0")], [])], at, 1 if "checkpoint" in name else None)
            add(parameters={"spark.sql.sources.provider": "delta"}, columns=_columns(df.schema))
        case "part_iceberg":
            df = src("part")
            where = write_iceberg(spark, [df.where("p_partkey % 2 = 0"), df.where("p_partkey % 2 = 1")], at, "s3://moved/lake/part")
            assert where.startswith(at)
            add(**described(ICEBERG), parameters={"table_type": "ICEBERG"})
        case "part_renamed":
            df = src("part")
            write_iceberg(spark, [df], at, renames={"p_name": "title", "p_type": "p_name"})  # a name moves to another column
            add(**described(ICEBERG), parameters={"table_type": "ICEBERG"})
        case "supplier_orc":
            df = src("supplier")
            df.write.orc(at)
            add(**described(ORC), columns=_columns(df.schema))
        case "nested":
            df = src("events").select("event_id", F.struct(F.col("user_id"), F.col("value").cast("decimal(12,2)").alias("value")).alias("s"), F.array("event_type", "props").alias("a"), F.create_map("event_type", F.col("value").cast("decimal(10,2)")).alias("m"))
            df.write.parquet(at)
            add(**parquet, columns=_columns(df.schema))
        case "customer_recorded":
            df = src("customer")
            df.write.option("sep", "|").option("header", "true").csv(at)
            whole = df.schema.json()
            cut = [whole[i : i + 120] for i in range(0, len(whole), 120)]
            add(**text, serde_parameters={"field.delim": "|"}, parameters={"spark.sql.sources.schema.numParts": str(len(cut)), **{f"spark.sql.sources.schema.part.{i}": c for i, c in enumerate(cut)}})
    return engine
