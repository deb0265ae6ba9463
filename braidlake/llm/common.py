"""What the text operators share.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which is how ``bytes.split()`` splits.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from braidlake.runtime import map_arrow

#: Rows handled at once in a Python worker; bounds its memory whatever Arrow's own batch size is.
ROWS = 256
#: Characters handled at once, unless a single text is longer.
CHARS = 4_000_000

FOLDS = 5


def pieces(batches: Iterator[pa.RecordBatch], text: str | None = "text", rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of at most ``rows`` rows and, but for single rows, ``CHARS`` bytes of text."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            piece = batch.slice(start, rows)
            while text and piece.num_rows > 1 and piece.column(piece.schema.get_field_index(text)).nbytes > CHARS:
                piece = piece.slice(0, piece.num_rows // 2)
            yield piece
            start += piece.num_rows


def map_pieces(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType, text: str | None = "text") -> DataFrame:
    """Run ``fn`` over small Arrow batches of ``df``; it returns the columns of ``schema`` by name."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            out = fn(piece)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for f, x in ((f, out[f.name]) for f in arrow)],
                schema=arrow,
            )

    return map_arrow(df, run, schema)


def filter_pieces(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows for which ``keep`` says so of their text, with all their columns as they were, of whatever names."""
    plain, names = plainly(df)
    text = place_of(names, "text")
    at = int(text[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            yield piece.filter(pa.array(keep(pa.RecordBatch.from_arrays([piece.column(at)], names=["text"])), type=pa.bool_()))

    return map_arrow(plain, run, plain.schema).toDF(*names)


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """rows and ``rank``, gapless from 0 within each value of key.

    rows: written, with ``mid`` (monotonically_increasing_id at that time). A key's rows are ranked apart in each
    of the partitions in which they were written, however many they are, after the counts of those before.
    """
    rows = rows.withColumn("part", F.shiftright("mid", 33))
    counts = rows.groupBy(key, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select(key, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    local = rows.withColumn("local", F.row_number().over(Window.partitionBy(key, "part").orderBy("mid")) - 1)
    return local.join(earlier, [key, "part"]).withColumn("rank", (F.col("earlier") + F.col("local")).cast("long")).drop("part", "earlier", "local", "mid")


def plainly(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with columns c0, c1 and so on, and their true names: no name can clash or need quotes."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))), docs.columns


def place_of(names: list[str], name: str) -> str:
    """The plain column of a name; one of another case counts where the name itself is missing."""
    alike = [i for i, x in enumerate(names) if x.lower() == name]
    exact = [i for i in alike if names[i] == name]
    return f"c{(exact or alike)[0]}"


def columns_of(docs: DataFrame, **kinds: str) -> DataFrame:
    """The named columns as the given types; other columns may have any names."""
    plain, names = plainly(docs)
    return plain.select(*(F.col(place_of(names, x)).cast(kind).alias(x) for x, kind in kinds.items()))


def with_row(docs: DataFrame, **kinds: str) -> DataFrame:
    """The named columns, and all columns as they are in one column ``_row``, which ``rows_of`` takes apart."""
    plain, names = plainly(docs)
    row = F.struct(*(F.col(f"c{i}") for i in range(len(names)))).alias("_row")
    return plain.select(row, *(F.col(place_of(names, x)).cast(kind).alias(x) for x, kind in kinds.items()))


def rows_of(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again, from the column ``_row``."""
    return kept.select("_row.*").toDF(*docs.columns)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


#: Hashes of ids are compared within this range.
RANGE = 1 << 40


def few_ids(ids: DataFrame, most: int) -> list[int]:
    """At most ``most`` of a table of distinct ids (its first column), those of the smallest hashes.

    A bound on the hash that twice as many are expected to meet comes first: otherwise every partition would send
    its own ``most`` rows.
    """
    name = ids.columns[0]
    total = ids.count()
    hashed = F.pmod(F.xxhash64(name), F.lit(RANGE))
    bound = min(RANGE, RANGE * (2 * most + 100) // max(1, total))
    return [r[0] for r in ids.where(hashed < bound).select(name).orderBy(hashed, name).limit(most).collect()]


def texts_of(piece: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return piece.column(piece.schema.get_field_index(name)).to_pylist()
