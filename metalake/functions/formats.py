"""Which storage format a table has."""

from __future__ import annotations

from ..model import Format, TableMeta


def detect(meta: TableMeta) -> Format:
    """By the writer's parameters first, then by class names; the first rule that holds."""
    p = {k: v.lower() for k, v in meta.parameters.items()}
    if p.get("spark.sql.sources.provider") == "delta":
        return Format.DELTA
    if p.get("table_type") in ("iceberg", "delta"):
        return Format(p["table_type"])
    classes, serde = meta.input_format, meta.serde
    rules = (
        (Format.ICEBERG, "HiveIcebergInputFormat" in classes),
        (Format.DELTA, "DELTA" in classes or "Delta" in serde),
        (Format.PARQUET, "Parquet" in classes or "Parquet" in serde),
        (Format.AVRO, "Avro" in classes or "Avro" in serde),
        (Format.CSV, "TextInputFormat" in classes or "LazySimpleSerDe" in serde),
        (Format.ORC, "Orc" in classes or "Orc" in serde),
    )
    return next((f for f, holds in rules if holds), Format.UNKNOWN)


def is_partitioned(meta: TableMeta) -> bool:
    return bool(meta.partition_keys)


def reader_name(kind: Format) -> str:
    return {Format.PARQUET: "parquet_scan", Format.DELTA: "delta_scan", Format.ICEBERG: "iceberg_scan", Format.AVRO: "read_avro", Format.CSV: "read_csv", Format.ORC: "read_orc"}.get(kind, "")


def needs_extension(kind: Format) -> bool:
    """False for all: table formats are read by this package itself, without other JVM packages."""
    return False
