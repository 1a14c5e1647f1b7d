"""CREATE TABLE in an attached catalog: metadata alone, no files."""

from __future__ import annotations

from pyspark.sql import types as T

from ..functions import paths, types
from ..model import ColumnMeta, InvalidInput, NotImplementedInCatalog, TableMeta
from .catalog import Catalog

# Class names of the catalog's storage descriptors (input, output, serialisation).
CLASSES = {
    "parquet": ("org.apache.hadoop.hive.ql.io.parquet.MapredParquetInputFormat", "org.apache.hadoop.hive.ql.io.parquet.MapredParquetOutputFormat", "org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe"),
    "csv": ("org.apache.hadoop.mapred.TextInputFormat", "org.apache.hadoop.hive.ql.io.HiveIgnoreKeyTextOutputFormat", "org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe"),
}


def create_table(catalog: Catalog, database: str, name: str, columns: list[tuple[str, T.DataType]], options: dict[str, str] | None = None, partitioned_by: list[str] | None = None) -> TableMeta:
    """Registers a table; options: location, format (or provider; parquet by default), delimiter, and others, which become parameters."""
    if catalog.read_only:
        raise InvalidInput(f"{catalog.name} is attached read-only")
    if not columns:
        raise InvalidInput("a table has columns")
    options = {k.lower(): v for k, v in (options or {}).items()}
    kind = (options.get("format") or options.get("provider") or "parquet").lower()
    if kind not in CLASSES:
        raise NotImplementedInCatalog(f"tables of format {kind} can't be created")
    database = catalog.resolve_schema(database)
    location = options.get("location")
    if not location:
        if not catalog.warehouse_location:
            raise InvalidInput("a location is needed where the catalog has no warehouse")
        location = paths.default_location(catalog.warehouse_location, database, name)
    warehouse = (catalog.warehouse_location or "").rstrip("/")
    managed = bool(warehouse) and (location == warehouse or location.startswith(warehouse + "/"))
    keys = partitioned_by or []
    unknown = [k for k in keys if k.lower() not in {n.lower() for n, _ in columns}]
    if unknown:
        raise InvalidInput(f"partition columns that aren't columns: {', '.join(unknown)}")
    column = lambda n, t: ColumnMeta(n, types.to_catalog_type(t))
    by = {k.lower() for k in keys}
    given = {k: v for k, v in options.items() if k not in ("location", "format", "delimiter")}
    meta = TableMeta(
        name, database, location, *CLASSES[kind], {"field.delim": options.get("delimiter", ",")} if kind == "csv" else {"serialization.format": "1"}, given,
        tuple(column(n, t) for n, t in columns if n.lower() not in by), tuple(column(n, t) for n, t in columns if n.lower() in by), "MANAGED_TABLE" if managed else "EXTERNAL_TABLE",
    )
    catalog.store.create_table(meta)
    catalog.clear_cache()
    return catalog.store.table(database, name)
