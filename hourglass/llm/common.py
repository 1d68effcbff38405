"""Helpers shared by the operators: table reads, shared scratch tables, and
row functions applied to Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hourglass.session import scratch_path

ROWS_AT_ONCE = 256


_CACHES: dict[str, dict] = {}


def cache(owner: str) -> dict:
    """What an operator keeps in a Python worker from task to task."""
    return _CACHES.setdefault(owner, {})


def release(owner: str | None = None) -> None:
    """Drop what other operators keep here: workers are used again by the next stage."""
    for name, held in _CACHES.items():
        if name != owner:
            held.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the
    lineage, and survives the loss of an executor."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def map_rows(df: DataFrame, args: list[str], make: Callable[[], Callable[..., tuple]], ddl: str,
             keep: list[str] | None = None, owner: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` as they are, and those of ``ddl``: the
    row function's results for the columns ``args``, of which strings arrive
    as UTF-8 bytes.  ``make()`` runs once in each task and returns the row
    function; ``owner`` names the cache that it may use.  Rows are taken a few at a time, so that memory follows the
    texts at hand.
    """
    keep = keep or []
    df = df.select(*(f"`{c}`" for c in dict.fromkeys([*keep, *args])))
    schema = StructType([f for f in df.schema if f.name in keep] + struct(ddl).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(owner)
        row, out = make(), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                given = (part.column(c) for c in args)
                given = (c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in given)
                made = zip(*(row(*values) for values in zip(*(c.to_pylist() for c in given))))
                columns = [part.column(c) for c in keep] + [pa.array(list(c), f.type) for c, f in zip(made, list(out)[len(keep):])]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return df.mapInArrow(run, schema)
