"""The engine: attached catalogs, and SQL and DataFrames over their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .functions import types
from .model import AlreadyExists, InvalidInput, NotFound
from .plans import sql as statements
from .plans.catalog import Catalog, Table
from .sources.metastore import Metastore, ThriftMetastore, parse_endpoint


class Catalogs(dict[str, Catalog]):
    """Catalogs by name; as with the host's own names, case doesn't tell them apart."""

    def key(self, name: str) -> str:
        return next((k for k in self if k.casefold() == name.casefold()), name)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and super().__contains__(self.key(name))

    def __getitem__(self, name: str) -> Catalog:
        return super().__getitem__(self.key(name))

    def pop(self, name: str, *default):
        return super().pop(self.key(name), *default)


class Engine:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.catalogs = Catalogs()
        self.current: tuple[str, str] | None = None
        self.options: dict[str, bool] = {"unsafe_enable_version_guessing": True}

    # ------------------------------------------------------------ catalogs
    def attach(self, uri: str, name: str, default_schema: str = "default", warehouse_location: str | None = None, read_only: bool = False, store: Metastore | None = None, ttl_s: float = 5.0) -> Catalog:
        """Attaches the service at uri (or a given store) under a name; no connection is made yet."""
        if name in self.catalogs:
            raise AlreadyExists(f"a catalog {name} is attached")
        if store is None:
            parse_endpoint(uri)
            store = ThriftMetastore(self.spark, uri)
        self.catalogs[name] = Catalog(self.spark, name, store, uri, default_schema, warehouse_location, read_only, ttl_s)
        return self.catalogs[name]

    def detach(self, name: str, missing_ok: bool = False) -> None:
        if self.catalogs.pop(name, None) is None and not missing_ok:
            raise NotFound(f"no catalog {name} is attached")
        if self.current and self.current[0].casefold() == name.casefold():
            self.current = None

    def attached(self) -> DataFrame:
        return self.rows([(n,) for n in sorted([*self.catalogs, "memory"])], "database_name string")

    def clear_cache(self) -> None:
        for c in self.catalogs.values():
            c.clear_cache()

    def rows(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    # ------------------------------------------------------------ names
    def place(self, name: list[str]) -> tuple[Catalog, str, str] | None:
        """(catalog, database, table) that a name stands for: catalog.database.table, catalog.table, or what the current catalog has."""
        if len(name) == 3 and name[0] in self.catalogs:
            return self.catalogs[name[0]], name[1], name[2]
        if len(name) == 2 and name[0] in self.catalogs:
            c = self.catalogs[name[0]]
            c.check_default()
            return c, c.default_schema, name[1]
        if self.current:
            c = self.catalogs[self.current[0]]
            return (c, self.current[1], name[0]) if len(name) == 1 else (c, name[0], name[1]) if len(name) == 2 else None
        return None

    def resolve(self, name: list[str]) -> Table | None:
        where = self.place(name)
        if where is None:
            return None
        catalog, database, table = where
        explicit = name[0] in self.catalogs and len(name) > 1
        if not explicit and not catalog.exists(database, table):
            return None
        return catalog.table(database, table)

    def relation(self, name: list[str]) -> DataFrame | None:
        if [x.lower() for x in name[-2:]] == ["information_schema", "schemata"]:
            return self.schemata()
        if [x.lower() for x in name[-2:]] == ["information_schema", "columns"]:
            return self.columns()
        found = self.resolve(name)
        return found.df() if found else None

    def catalog_table(self, name: str) -> Table:
        found = self.resolve(statements.parts_of(name))
        if found is None:
            raise NotFound(f"no table {name}")
        return found

    def table(self, name: str) -> DataFrame:
        return self.catalog_table(name).df()

    # ------------------------------------------------------------ metadata
    def describe(self, name: str) -> DataFrame:
        fields = self.catalog_table(name).schema().fields
        return self.rows([(f.name, types.display_name(f.dataType), "YES", None, None, None) for f in fields], "column_name string, column_type string, `null` string, `key` string, `default` string, extra string")

    def schemata(self) -> DataFrame:
        rows = [(n, d) for n, c in self.catalogs.items() for d in c.databases()]
        return self.rows(sorted(rows), "catalog_name string, schema_name string")

    def columns(self) -> DataFrame:
        rows = [(n, d, t, c, i, k, "YES") for n, cat in self.catalogs.items() for d in cat.databases() for t, c, i, k in cat.columns(d)]
        return self.rows(rows, "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int, data_type string, is_nullable string")

    def lineage(self, name: str):
        return self.catalog_table(name).lineage()

    # ------------------------------------------------------------ settings
    def create_secret(self, name: str = "default", **options: str) -> None:
        """Credentials for an object store, set where Hadoop's file systems look for them; scope: the bucket they are for (all without)."""
        kind = options.pop("type", "s3").lower()
        if kind != "s3":
            raise InvalidInput(f"secrets of type {kind} aren't supported")
        scope = options.pop("scope", "").removeprefix("s3a://").removeprefix("s3://").split("/")[0]
        at = f"fs.s3a.bucket.{scope}." if scope else "fs.s3a."
        names = {"key_id": "access.key", "secret": "secret.key", "session_token": "session.token", "endpoint": "endpoint", "region": "endpoint.region", "use_ssl": "connection.ssl.enabled"}
        conf = self.spark._jsc.hadoopConfiguration()
        for k, v in options.items():
            if k in names:
                conf.set(at + names[k], v)
            elif k == "url_style":
                conf.set(at + "path.style.access", str(v == "path").lower())
            elif k != "provider":
                raise InvalidInput(f"unknown option of a secret: {k}")

    # ------------------------------------------------------------ statements
    def sql(self, text: str) -> DataFrame:
        """A command for catalogs, or a query over theirs and Spark's own tables."""
        found = statements.command(self, text)
        return found if found is not None else statements.query(self, text)
