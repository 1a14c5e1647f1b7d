"""Metadata of catalogued tables, and the errors of this package."""

from __future__ import annotations

import enum
from dataclasses import dataclass, field


class MetalakeError(Exception):
    """Base of this package's errors."""


class CatalogUnavailable(MetalakeError):
    """The catalog service can't be reached."""


class NotFound(MetalakeError):
    """No such database or table."""


class AlreadyExists(MetalakeError):
    """The table is there already."""


class UnsupportedType(MetalakeError):
    """A type string without a Spark type."""


class UnsupportedFormat(MetalakeError):
    """A storage format, or a feature of it, that isn't read here."""


class NotImplementedInCatalog(MetalakeError, NotImplementedError):
    """A statement that attached catalogs don't support."""


class InvalidInput(MetalakeError, ValueError):
    """A malformed address, option or statement."""


class Format(enum.Enum):
    PARQUET = "parquet"
    DELTA = "delta"
    ICEBERG = "iceberg"
    AVRO = "avro"
    CSV = "csv"
    ORC = "orc"
    UNKNOWN = "unknown"


@dataclass(frozen=True)
class ColumnMeta:
    name: str
    type: str
    comment: str | None = None


@dataclass(frozen=True)
class TableMeta:
    name: str
    database: str
    location: str = ""
    input_format: str = ""
    output_format: str = ""
    serde: str = ""
    serde_parameters: dict[str, str] = field(default_factory=dict)
    parameters: dict[str, str] = field(default_factory=dict)
    columns: tuple[ColumnMeta, ...] = ()
    partition_keys: tuple[ColumnMeta, ...] = ()
    table_type: str = "EXTERNAL_TABLE"

    @property
    def tags(self) -> dict[str, str]:
        """What lineage tools read beside the columns: the storage facts and all table parameters."""
        own = {"location": self.location, "table_type": self.table_type, "input_format": self.input_format, "output_format": self.output_format, "serialization_lib": self.serde}
        return {**self.parameters, **{f"hms_{'storage_location' if k == 'location' else k}": v for k, v in own.items()}}


@dataclass(frozen=True)
class LineageInfo:
    qualified_name: str
    location: str
    table_type: str
    catalog: str
    database: str
    table: str
    scan_name: str
