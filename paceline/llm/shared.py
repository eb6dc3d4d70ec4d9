"""Helpers that several operators use: Arrow mapping and reading of tables, and where cut lineage is written."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from ..lineage import shared_folder, written

__all__ = ["arrow_filter", "arrow_map", "shared_folder", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, schema: str, of_batch: Callable[[dict[str, list]], Iterator[dict[str, list]] | dict[str, list]], rows: int = 512) -> DataFrame:
    """Apply `of_batch` to slices of at most `rows` rows; it takes and returns columns as lists."""
    out = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                cols = of_batch({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def arrow_filter(df: DataFrame, columns: list[str], of_batch: Callable[[dict[str, list]], list[bool]], rows: int = 512) -> DataFrame:
    """The rows, with all their columns, that `of_batch` keeps, judged by some columns of slices of at most `rows` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield part.filter(pa.array(of_batch({n: part.column(part.schema.get_field_index(n)).to_pylist() for n in columns}), pa.bool_()))

    return df.mapInArrow(run, df.schema)
