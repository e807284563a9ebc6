"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from driftline.sources.folders import shared_folder

#: A word is a maximal run of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Characters of text (or bytes of packed text) of a batch that a Python worker handles at once.
PORTION = 1 << 20
#: Most bits of a bitmap of rows (8 MB), whatever the number of rows.
MOST_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORD_GAP), lambda w: w != "")


def constant(values: list, kind: str) -> Column:
    """An array as one constant, which the optimizer folds; far cheaper to plan than a literal for each element."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def let(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: what follows refers to it, no expression is copied into a filter or lambda."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until df has no such column (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame, gathered: int | None = None) -> DataFrame:
    """df written to the shared folder as Parquet and read again: what builds on it survives lost executors without recomputing it.

    For large rows: `gathered` is about how many bytes make a row group, which is held in memory whole; its size is
    looked at after each row, not after 100.
    """
    path = f"{shared_folder(df.sparkSession)}/driftline-{uuid.uuid4().hex}"
    often = {"parquet.block.size": gathered, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}
    df.write.options(**(often if gathered else {})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def spent(*cuts: DataFrame) -> None:
    """Delete the folders of cut() results that nothing reads any more."""
    for df in cuts:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def portions(b: pd.DataFrame, column: str, most: int = PORTION) -> Iterator[pd.DataFrame]:
    """The batch in slices of about `most` characters or bytes of the column; a longer value is a slice of its own."""
    sizes = np.fromiter((0 if v is None else len(v) for v in b[column]), np.int64, len(b))
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    for first, end in zip([0, *cuts], [*cuts, len(b)], strict=True):
        if end > first:
            yield b.iloc[first:end]


def row_of(key: str, text: str) -> Column:
    """A hash of key and text that tells rows apart, whether the key is null or repeated; equal rows share it."""
    return F.xxhash64(F.col(key), F.col(text))


def identity(key: str, text: str) -> list[Column]:
    """row, late (the key is null), id (0 for a null key): so that no null makes pandas turn keys into floats."""
    return [row_of(key, text).alias("row"), F.col(key).isNull().alias("late"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id")]


class Members:
    """A bitmap of row hashes of bounded size. It only ever lets too many through: at 10**9 rows nearly all, which costs shuffling but no result."""

    def __init__(self, rows: DataFrame, column: str = "row") -> None:
        self.bits = min(MOST_BITS, 1 << max(12, (rows.count() * 16).bit_length()))
        place = F.pmod(F.col(column), F.lit(self.bits))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
        found = rows.groupBy(F.floor(place / 64).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
        self.table = np.zeros(self.bits // 64, np.int64)
        self.table[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)

    def hold(self, rows: pd.Series) -> np.ndarray:
        """Whether each row may be a member."""
        place = rows.to_numpy(np.int64) & (self.bits - 1)
        return (self.table[place >> 6] >> (place & 63)) & 1 == 1


def unpacked(packed: pd.Series) -> Iterator[bytes]:
    """The texts of packed rows, one by one."""
    return map(zstandard.ZstdDecompressor().decompress, packed)


def packed_texts(docs: DataFrame, members: DataFrame, key: str, text: str, shared=None) -> DataFrame:
    """row, late, id, packed: the compressed texts of the rows of docs that may be in `members` (column row); a few too many.

    Rows that are surely none are dropped before anything is shuffled; what is shuffled is compressed. `shared` is a
    broadcast Members, where one is there already.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Members(members)) if shared is None else shared

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for part in portions(b[shared.value.hold(b["row"])], "text"):
                packed = pd.Series([c.compress((t or "").encode()) for t in part["text"]], part.index, object)
                yield pd.DataFrame({"row": part["row"], "late": part["late"], "id": part["id"], "packed": packed})

    rows = docs.select(*identity(key, text), F.col(text).alias("text"))
    return rows.mapInPandas(run, "row long, late boolean, id long, packed binary")
