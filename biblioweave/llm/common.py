"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LEAST = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the whole ``text``; a null text is empty, other columns go."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a lambda of one Column)."""
    return F.transform(F.array(value), body)[0]


def slices(batch: pa.RecordBatch, column: str, budget: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``budget`` bytes, so that arrays made of it stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > budget:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 16
    if start < batch.num_rows:
        yield batch.slice(start)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def append(df: DataFrame, make, fields: dict[str, tuple[str, pa.DataType]], text_col: str = "text") -> DataFrame:
    """Add columns that ``make()(texts)`` gives for lists of whole texts (null: empty); all other columns pass through.

    ``make`` runs once per task, so it can hold what a task reuses. No shuffle; about two megabytes of text at a time.
    """
    clash = [f for f in fields if f in df.columns]
    if clash:
        raise ValueError(f"the table has the columns {clash} already")
    schema = df.select("*", *[F.lit(None).cast(kind).alias(name) for name, (kind, _) in fields.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for whole in batches:
            for batch in slices(whole, text_col):
                made = find([t or "" for t in batch.column(text_col).to_pylist()])
                columns = [pa.array(c, kind) for c, (_, kind) in zip(made, fields.values())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *fields])

    return df.mapInArrow(run, schema)
