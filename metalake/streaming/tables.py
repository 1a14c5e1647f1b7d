"""Catalogued tables as streams of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..engine import Engine
from ..functions import paths
from ..functions.formats import detect
from ..model import Format, UnsupportedFormat


def table_stream(engine: Engine, name: str, **options: str) -> DataFrame:
    """A table of Parquet or ORC files as a stream: watermarks, windows and sinks are Spark's own."""
    table = engine.catalog_table(name)
    kind = detect(table.meta)
    if kind not in (Format.PARQUET, Format.ORC):
        raise UnsupportedFormat(f"{name}: tables of format {kind.value} aren't streamed")
    return engine.spark.readStream.format(kind.value).schema(table.schema()).options(**options).load(paths.normalise(table.meta, kind))
