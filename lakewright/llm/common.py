"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that one step inside a task holds as Python objects at a time.
SLICE_ROWS = 256

#: Bits of a bitmap for each of its keys, and at most; beyond that more rows than wanted pass it.
BITS_A_KEY = 32
MOST_BITS = 1 << 28

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no other column of the
    input can clash with what the operator adds."""
    return df.select(*(F.col(quoted(column)).alias(own) for own, column in columns.items()))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(id_column: Column) -> Column:
    """The quarter of the rows that nothing is learned from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def may_be_in(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``column`` is one of ``keys`` (one column, as its name), and a few others.

    A bitmap of the keys' hashes goes to every task, so rows stay where they are: long ones that are not
    wanted are never shuffled. Whoever needs exactly the keys joins what is left.
    """
    bits = min(max(BITS_A_KEY * keys.count(), 1 << 15), MOST_BITS)

    def place(key: str) -> Column:
        return F.pmod(F.xxhash64(quoted(key)), F.lit(bits)) + 1

    maps = keys.select(place(keys.columns[0]).alias("place")).groupBy(F.bitmap_bucket_number("place").alias("map_of")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map")
    )
    at = F.bitmap_bit_position(place(column))
    byte = F.conv(F.hex(F.substring(F.col("map"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place(column)) == F.col("map_of"))
    return found.filter(F.call_function("shiftright", byte, (at % 8).cast("int")) % 2 == 1).select(*map(quoted, rows.columns))


def release_memory() -> None:
    """Between batches and at the end of a task, as Arrow keeps what they took and the worker lives on in later stages."""
    pa.default_memory_pool().release_unused()


def mapped(df: DataFrame, rows: Callable[[list[list]], Iterator[tuple] | list[tuple]], schema: str) -> DataFrame:
    """``rows`` gets the columns of a slice of rows as lists and returns tuples of ``schema``.
    Only one slice at a time exists as Python objects, whatever the size of the Arrow batch."""
    spark = df.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = spark.createDataFrame([], schema).schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                out = list(rows([c.to_pylist() for c in part.columns]))
                if out:
                    arrays = [pa.array(list(values), f.type) for values, f in zip(zip(*out), arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        release_memory()

    return df.mapInArrow(run, schema=kind)


def filtered(df: DataFrame, text_column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df`` whose text ``keep`` marks, all columns as they are and in place.
    Columns go to the tasks under plain names, as not every name can be passed on."""
    at = df.columns.index(text_column)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, schema=plain.schema).toDF(*df.columns)
