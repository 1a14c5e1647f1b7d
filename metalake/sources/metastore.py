"""Catalog services: one in memory, and the Thrift service through the client on Spark's own class path."""

from __future__ import annotations

from dataclasses import replace
from typing import Protocol

from pyspark.sql import SparkSession

from ..functions.paths import iceberg_root
from ..model import AlreadyExists, CatalogUnavailable, ColumnMeta, InvalidInput, NotFound, TableMeta

BATCH = 300  # tables of one request


class Metastore(Protocol):
    def databases(self) -> list[str]: ...
    def tables(self, database: str) -> list[str]: ...
    def table(self, database: str, name: str) -> TableMeta: ...
    def tables_by_name(self, database: str, names: list[str]) -> list[TableMeta]: ...
    def create_table(self, meta: TableMeta) -> None: ...


def parse_endpoint(uri: str, default_port: int = 9083) -> tuple[str, int]:
    """(host, port) of an address host[:port], with or without its scheme."""
    rest = uri.removeprefix("thrift://")
    host, colon, port = rest.partition(":")
    if "://" in rest or not host or ":" in port or (colon and not (port.isascii() and port.isdigit() and 0 < int(port) < 65536)):
        raise InvalidInput(f"not the address of a catalog service: {uri!r}")
    return host, int(port) if colon else default_port


class MemoryMetastore:
    """A catalog in this process."""

    def __init__(self, databases: list[str] | None = None):
        self._data: dict[str, dict[str, TableMeta]] = {d: {} for d in databases or ["default"]}

    def add_database(self, name: str) -> None:
        self._data.setdefault(name, {})

    def databases(self) -> list[str]:
        return list(self._data)

    def _database(self, name: str) -> dict[str, TableMeta]:
        found = next((v for k, v in self._data.items() if k.casefold() == name.casefold()), None)
        if found is None:
            raise NotFound(f"no database {name}")
        return found

    def tables(self, database: str) -> list[str]:
        return list(self._database(database))

    def table(self, database: str, name: str) -> TableMeta:
        found = next((v for k, v in self._database(database).items() if k.casefold() == name.casefold()), None)
        if found is None:
            raise NotFound(f"no table {database}.{name}")
        return found

    def tables_by_name(self, database: str, names: list[str]) -> list[TableMeta]:
        return [self.table(database, n) for n in names if n in self._database(database)]

    def create_table(self, meta: TableMeta) -> None:
        tables = self._database(meta.database)
        if any(k.casefold() == meta.name.casefold() for k in tables):
            raise AlreadyExists(f"{meta.database}.{meta.name} exists")
        tables[meta.name] = meta

    def drop_table(self, database: str, name: str) -> None:
        self._database(database).pop(name, None)


class ThriftMetastore:
    """The Thrift service at host:port. A connection is made at the first call and once more after a failure."""

    def __init__(self, spark: SparkSession, uri: str, timeout_s: int = 20):
        self.host, self.port = parse_endpoint(uri)
        self._spark, self._timeout, self._client = spark, timeout_s, None

    @property
    def _api(self):
        return self._spark._jvm.org.apache.hadoop.hive.metastore.api

    def _connect(self):
        jvm = self._spark._jvm
        conf = jvm.org.apache.hadoop.hive.conf.HiveConf()
        conf.set("hive.metastore.uris", f"thrift://{self.host}:{self.port}")
        for key in ("hive.metastore.client.socket.timeout", "hive.metastore.client.connect.retry.delay"):
            conf.set(key, f"{self._timeout if 'timeout' in key else 1}s")
        conf.set("hive.metastore.connect.retries", "1")
        conf.set("hive.metastore.failure.retries", "1")
        conf.set("hive.metastore.execute.setugi", "false")
        return jvm.org.apache.hadoop.hive.metastore.HiveMetaStoreClient(conf)

    def _call(self, name: str, *args):
        from py4j.protocol import Py4JJavaError

        for again in (True, False):
            try:
                if self._client is None:
                    self._client = self._connect()
                return getattr(self._client, name)(*args)
            except Py4JJavaError as e:
                kind = e.java_exception.getClass().getSimpleName()
                if kind in ("NoSuchObjectException", "UnknownDBException", "InvalidObjectException", "InvalidOperationException"):
                    raise NotFound(f"{name}: {e.java_exception.getMessage()}") from None
                if kind == "AlreadyExistsException":
                    raise AlreadyExists(e.java_exception.getMessage()) from None
                self._client = None
                if not again:
                    raise CatalogUnavailable(f"{self.host}:{self.port}: {e.java_exception.getMessage()}") from None

    def databases(self) -> list[str]:
        return list(self._call("getAllDatabases"))

    def tables(self, database: str) -> list[str]:
        return list(self._call("getAllTables", database))

    def table(self, database: str, name: str) -> TableMeta:
        return self._meta(self._call("getTable", database, name))

    def tables_by_name(self, database: str, names: list[str]) -> list[TableMeta]:
        out = []
        for i in range(0, len(names), BATCH):
            wanted = self._spark._jvm.java.util.ArrayList()
            for n in names[i : i + BATCH]:
                wanted.add(n)
            out += [self._meta(t) for t in self._call("getTableObjectsByName", database, wanted)]
        return [m for m in out if m.database.casefold() == database.casefold()]

    def database(self, name: str) -> dict[str, str]:
        d = self._call("getDatabase", name)
        return {"name": d.getName(), "description": d.getDescription() or "", "location": d.getLocationUri() or ""}

    def close(self) -> None:
        if self._client is not None:
            self._client.close()
            self._client = None

    @staticmethod
    def _meta(t) -> TableMeta:
        sd = t.getSd()
        serde = sd.getSerdeInfo() if sd is not None else None
        columns = lambda xs: tuple(ColumnMeta(c.getName(), c.getType(), c.getComment()) for c in xs or ())
        text = lambda x: x or ""
        parameters = dict(t.getParameters() or {})
        meta = TableMeta(
            t.getTableName(), t.getDbName(), text(sd.getLocation()) if sd is not None else "", text(sd.getInputFormat()) if sd is not None else "", text(sd.getOutputFormat()) if sd is not None else "",
            text(serde.getSerializationLib()) if serde is not None else "", dict(serde.getParameters() or {}) if serde is not None else {}, parameters,
            columns(sd.getCols() if sd is not None else ()), columns(t.getPartitionKeys()), t.getTableType() or ("VIRTUAL_VIEW" if t.getViewOriginalText() else "EXTERNAL_TABLE"),
        )
        return replace(meta, location=iceberg_root(parameters.get("metadata_location", ""), meta.location))

    def create_table(self, meta: TableMeta) -> None:
        jvm, api = self._spark._jvm, self._api
        listed = lambda xs: _list(jvm, [api.FieldSchema(c.name, c.type, c.comment or "") for c in xs])
        serde = api.SerDeInfo()
        serde.setName(meta.name)
        serde.setSerializationLib(meta.serde)
        serde.setParameters(_map(jvm, meta.serde_parameters))
        sd = api.StorageDescriptor()
        sd.setCols(listed(meta.columns))
        sd.setLocation(meta.location)
        sd.setInputFormat(meta.input_format)
        sd.setOutputFormat(meta.output_format)
        sd.setSerdeInfo(serde)
        t = api.Table()
        t.setDbName(meta.database)
        t.setTableName(meta.name)
        t.setTableType(meta.table_type)
        t.setSd(sd)
        t.setPartitionKeys(listed(meta.partition_keys))
        t.setParameters(_map(jvm, meta.parameters | ({"EXTERNAL": "TRUE"} if meta.table_type == "EXTERNAL_TABLE" else {})))
        self._call("createTable", t)


def _list(jvm, items):
    out = jvm.java.util.ArrayList()
    for x in items:
        out.add(x)
    return out


def _map(jvm, items: dict[str, str]):
    out = jvm.java.util.HashMap()
    for k, v in items.items():
        out.put(k, v)
    return out
