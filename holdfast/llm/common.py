"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` without an argument splits at exactly these.
SPACES = b" \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that further columns can't clash with its own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the folds that the contracts fix. A null id belongs to no held-out fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1)).cast("long")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, one object per row."""
    column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return (column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)).tolist()


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of text; a longer single text comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)


@lru_cache(maxsize=1)
def _c_library() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: it gives memory back in its own way
        return None


def release() -> None:
    """Give freed memory back to the system: workers are used again, and what they hold adds up beside the JVM."""
    pa.default_memory_pool().release_unused()
    if (library := _c_library()) is not None:
        library.malloc_trim(0)
