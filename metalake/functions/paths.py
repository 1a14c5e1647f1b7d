"""Storage locations: placeholders, schemes, endpoints, table roots and globs."""

from __future__ import annotations

from urllib.parse import urlsplit

from ..model import Format, TableMeta

PLACEHOLDER = "-__PLACEHOLDER__"


def strip_placeholder(path: str) -> str:
    return path.partition(PLACEHOLDER)[0]


def endpoint_of(path: str) -> tuple[str, str] | None:
    """(bucket, endpoint) of a plain HTTP address of an object store that isn't the public one."""
    parts = urlsplit(path)
    if parts.scheme != "http" or not parts.path.strip("/") or (parts.port is None and parts.hostname == "s3.amazonaws.com"):
        return None
    return parts.path.strip("/").split("/")[0], parts.netloc


def to_hadoop(path: str) -> str:
    """A location as Hadoop's file systems take it."""
    if endpoint_of(path):
        return f"s3a://{urlsplit(path).path.strip('/')}"
    for scheme in ("s3://", "s3n://"):
        if path.startswith(scheme):
            return "s3a://" + path.removeprefix(scheme)
    return path


def to_display(path: str) -> str:
    """The short scheme that users write."""
    return "s3://" + path.removeprefix("s3a://") if path.startswith("s3a://") else path


def normalise(meta: TableMeta, kind: Format) -> str:
    """Where a table's files are: Delta's own location first; with a closing slash for Delta, without one otherwise."""
    path = meta.location
    if kind is Format.DELTA:
        path = meta.parameters.get("location") or meta.parameters.get("path") or path
    if kind is Format.ICEBERG:
        path = iceberg_root(meta.parameters.get("metadata_location", ""), path)
    path = to_hadoop(strip_placeholder(path)).rstrip("/")
    return path + "/" if kind is Format.DELTA else path


def iceberg_root(metadata_location: str, location: str) -> str:
    root, found, _ = metadata_location.partition("/metadata/")
    return root if found else location


def has_extension(path: str) -> bool:
    return "." in path.rstrip("/").rpartition("/")[2]


def glob(path: str, kind: Format, partitioned: bool) -> str:
    """The glob that names a table's files."""
    if kind in (Format.DELTA, Format.ICEBERG) or has_extension(path):
        return path
    suffix = {Format.PARQUET: "*.parquet", Format.AVRO: "*.avro"}.get(kind, "[!_]*")
    return f"{path.rstrip('/')}/{'**/' if partitioned else ''}{suffix}"


def s3_options(bucket: str, endpoint: str) -> dict[str, str]:
    """Settings of one bucket alone."""
    at = f"fs.s3a.bucket.{bucket}."
    return {at + "endpoint": endpoint, at + "path.style.access": "true", at + "connection.ssl.enabled": "false"}


def default_location(warehouse: str, database: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{database}/{table}"
