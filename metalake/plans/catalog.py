"""An attached catalog: cached listings, tables resolved when they are asked for."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import types
from ..functions.formats import detect
from ..model import CatalogUnavailable, Format, InvalidInput, LineageInfo, NotFound, TableMeta, UnsupportedType
from ..sources import scan
from ..sources.metastore import Metastore

log = logging.getLogger(__name__)
DEFAULT = "DEFAULT_SCHEMA"


@dataclass
class Table:
    """A catalogued table; its schema and DataFrame are made on first use."""

    catalog: Catalog
    meta: TableMeta
    _df: DataFrame | None = field(default=None, repr=False)

    @property
    def qualified_name(self) -> str:
        return f"{self.catalog.name}.{self.meta.database}.{self.meta.name}"

    @property
    def tags(self) -> dict[str, str]:
        return self.meta.tags

    def df(self) -> DataFrame:
        if self._df is None:
            self._df = scan.read(self.catalog.spark, self.meta).alias(self.meta.name)
        return self._df

    def schema(self) -> T.StructType:
        """From the files where they tell it, else the writer's record, else the catalog's columns."""
        kind = detect(self.meta)
        if kind in (Format.PARQUET, Format.DELTA, Format.ICEBERG):
            try:
                return self.df().schema
            except Exception as e:  # noqa: BLE001  any failure falls through to what is recorded
                log.warning("%s: schema from files failed: %s", self.qualified_name, e)
        recorded = types.recorded_schema(self.meta.parameters)
        schema = recorded or types.declared_schema(self.meta)
        return types.avro_physical(schema) if kind is Format.AVRO else schema

    def lineage(self) -> LineageInfo:
        m = self.meta
        return LineageInfo(self.qualified_name, m.location, m.table_type, self.catalog.name, m.database, m.name, f"hms_scan##{quote(self.qualified_name, safe='')}")


class Catalog:
    """Listings live ttl_s seconds and are then replaced whole, so changed and dropped tables show."""

    kind = "hive_metastore"

    def __init__(self, spark: SparkSession, name: str, store: Metastore, uri: str = "", default_schema: str = "default", warehouse_location: str | None = None, read_only: bool = False, ttl_s: float = 5.0):
        self.spark, self.name, self.store, self.uri = spark, name, store, uri
        self.default_schema, self.warehouse_location, self.read_only, self.ttl_s = default_schema, warehouse_location, read_only, ttl_s
        self._cache: dict[tuple, tuple[float, object]] = {}

    def _cached(self, key: tuple, make):
        now = time.monotonic()
        found = self._cache.get(key)
        if found is None or now - found[0] > self.ttl_s:
            found = self._cache[key] = (now, make())
        return found[1]

    def resolve_schema(self, name: str) -> str:
        return self.default_schema if name == DEFAULT else name

    def databases(self) -> list[str]:
        try:
            return sorted(self._cached(("databases",), self.store.databases))
        except CatalogUnavailable as e:
            log.warning("%s: %s", self.name, e)
            return []

    def tables(self, database: str) -> list[str]:
        database = self.resolve_schema(database)
        try:
            return sorted(self._cached(("tables", database.casefold()), lambda: self.store.tables(database)))
        except CatalogUnavailable as e:
            log.warning("%s: %s", self.name, e)
            return []

    def table(self, database: str, name: str) -> Table:
        database = self.resolve_schema(database)
        return self._cached(("table", database.casefold(), name.casefold()), lambda: Table(self, self.store.table(database, name)))

    def all_tables(self, database: str) -> list[Table]:
        """Every table of a database; one that can't be described doesn't hide the others."""
        names = self.tables(database)
        return [Table(self, m) for m in self.store.tables_by_name(self.resolve_schema(database), names)]

    def columns(self, database: str) -> list[tuple[str, str, int, str]]:
        """(table, column, place, type) of every table that can be described."""
        out = []
        for t in self.all_tables(database):
            try:
                fields = t.schema().fields
            except UnsupportedType as e:
                log.warning("%s: %s", t.qualified_name, e)
                continue
            out += [(t.meta.name, f.name, i + 1, types.display_name(f.dataType)) for i, f in enumerate(fields)]
        return sorted(out, key=lambda r: (r[0], r[2]))

    def refresh(self, database: str, name: str) -> Table:
        self._cache.pop(("table", self.resolve_schema(database).casefold(), name.casefold()), None)
        t = self.table(database, name)
        self.spark.catalog.refreshByPath(t.meta.location)
        return t

    def clear_cache(self) -> None:
        self._cache.clear()

    def exists(self, database: str, name: str) -> bool:
        try:
            self.table(database, name)
        except NotFound:
            return False
        return True

    def check_default(self) -> None:
        if not self.default_schema:
            raise InvalidInput(f"{self.name} has no default schema")
