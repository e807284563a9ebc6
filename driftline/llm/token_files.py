"""Operator 11: files of token ids, compressed by Re-Pair, shard by shard, with random access.

A data set of two folders. `shards` has a row for each shard of about SHARD ids: the grammar (rules, lengths of
expansions, symbols), the documents in it and where each ends. `parts` has a row for each task that wrote shards, with
the number of ids before it. Both are Parquet written by Spark, so a lost task is written again and nothing half
written is ever read. The rows are in ascending doc_id order over parts, shards and places within a shard.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from driftline.llm.bpe import byte_chars
from driftline.llm.repair import Grammar, compress, kind

#: Ids of a shard; a longer document is a shard of its own.
SHARD = 1 << 20
#: Stretches between white space that a worker remembers in a generation, and the longest of them in bytes.
CACHE, CACHED_BYTES = 600_000, 40
#: Marks that are tokens of their own behind a letter, and words of Latin letters (but for one whose lower case is two characters) with marks behind.
MARKS = ".,;:!?)$%&*#|<>"
LATIN = re.compile(rf"([A-Za-zªºÀ-ÖØ-öø-įı-ɏ]+)([{re.escape(MARKS)}]*)")
#: Rows that are taken out of an Arrow batch at once.
SLICE = 256

SHARDS = "part int, shard int, at long, n_ids long, doc_ids array<long>, doc_ends array<long>, terminals int, rules binary, lengths binary, symbols binary"


class Encoder(dict):
    """A tokenizer that drops white space, so that each stretch between it is encoded on its own and remembered.

    The ids of a stretch are the library's. One that is a Latin word, or a word and a mark, is given to the
    library's model in the form that its normalizer makes of it, which saves most of the time of a call; whether
    that is the same for this tokenizer is tried out at the start. The memory is two generations of CACHE stretches.
    """

    def __init__(self, data: bytes) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.terminals = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = kind(self.terminals)
        self.old: dict[bytes, bytes] = {}
        self.char = {b: c for c, b in byte_chars().items()}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        for probe in ("a b", "It's 12\t\n(x).", "é\u000b\u000cß", *special):
            if self._plain(probe) != b"".join(self._plain(t) for t in probe.split()):
                raise ValueError("white space is part of the ids of this tokenizer")
        self.direct = all(self._plain(w) == self._word(w) for w in ("Straße", "ÉTÉ", "abcDEF", "ıǅ", "the")) and all(
            self._plain(f"aÉ{m}") == self._word("aÉ") + self._plain(m) for m in (*MARKS, "!!", ".,)", "$$$", "#<|&>")
        )

    def _plain(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        chars = "".join(map(self.char.__getitem__, word.lower().encode()))
        return self._packed([t.id for t in self.model.tokenize(chars)])

    def _packed(self, ids: list[int]) -> bytes:
        return array("H" if self.kind.itemsize == 2 else "I", ids).tobytes()

    def _encode(self, s: bytes) -> bytes:
        if self.direct:
            if s.isalpha():  # ASCII letters only, as s is bytes
                low = s.lower()
                return self._packed([t.id for t in self.model.tokenize(low.decode())]) if low == s else self[low]
            word = s.rstrip(MARKS.encode())
            if word.isalpha():
                return self[word] + self[s[len(word) :]]
            if found := LATIN.fullmatch(s.decode()):
                return self[word] + self[s[len(word) :]] if found[2] else self._word(found[1])
        return self._plain(s.decode())

    def __missing__(self, s: bytes) -> bytes:
        ids = self.old.get(s)
        if ids is None:
            ids = self._encode(s)
        if len(s) <= CACHED_BYTES:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[s] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian integers; none for null."""
        return b"".join(map(self.__getitem__, (text or "").encode().split()))  # bytes split at ASCII white space only


_ENCODERS: dict[int, Encoder] = {}


def encoder(shared) -> Encoder:
    """The encoder of this Python worker for a broadcast tokenizer file."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


class _Writer:
    """Gathers encoded documents of one task and turns them into rows of SHARDS."""

    def __init__(self, terminals: int, size: int) -> None:
        self.part, self.shard, self.at, self.terminals, self.size = TaskContext.get().partitionId(), 0, 0, terminals, size
        self.keys: list[int | None] = []
        self.ids: list[bytes] = []
        self.n = 0

    def add(self, key: int | None, ids: bytes, n: int) -> Iterator[pa.RecordBatch]:
        if self.n and self.n + n > self.size:
            yield self.flush()
        self.keys.append(key)
        self.ids.append(ids)
        self.n += n

    def flush(self) -> pa.RecordBatch:
        width = kind(self.terminals)
        g = compress(np.frombuffer(b"".join(self.ids), width), self.terminals)
        ends = np.cumsum([len(i) // width.itemsize for i in self.ids])
        cells = {
            "part": pa.array([self.part], pa.int32()),
            "shard": pa.array([self.shard], pa.int32()),
            "at": pa.array([self.at], pa.int64()),
            "n_ids": pa.array([self.n], pa.int64()),
            "doc_ids": pa.array([self.keys], pa.list_(pa.int64())),
            "doc_ends": pa.array([ends], pa.list_(pa.int64())),
            "terminals": pa.array([self.terminals], pa.int32()),
            "rules": _binary([g.rules.tobytes()]),
            "lengths": _binary([g.lengths.astype("<u4").tobytes()]),
            "symbols": _binary([g.symbols.tobytes()]),
        }
        self.at, self.shard, self.keys, self.ids, self.n = self.at + self.n, self.shard + 1, [], [], 0
        return pa.RecordBatch.from_pydict(cells)


def grammar(row: dict) -> Grammar:
    """The grammar of one row of `shards`."""
    width = kind(row["terminals"])
    of = lambda name, dtype: np.frombuffer(row[name], dtype)
    return Grammar(row["terminals"], of("rules", width).reshape(-1, 2), of("lengths", "<u4").astype(np.int64), of("symbols", width))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", shard: int = SHARD) -> None:
    """Write the ids of each whole text, `end_id` after each, to `path` in ascending order of the key.

    A null or empty text has its end id only. Null keys come last; rows that share a key, and repeated rows, are all
    written, in the order of their texts. An empty table gives files without shards. Other columns are not written.
    Range partitions hold about as many rows each; a key that fills several of them is split by its texts. One shuffle
    of the texts; a task holds one shard (a longer document whole) and one batch.
    """
    spark = docs.sparkSession
    order = [F.col("late"), F.col("key"), F.xxhash64("text"), F.col("text")]
    rows = docs.select(F.col(key).isNull().alias("late"), F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*order[:3]).sortWithinPartitions(*order).select("key", "text")

    with open(tokenizer_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())  # one or two MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared)
        out, last = _Writer(enc.terminals, shard), np.array([end_id], enc.kind).tobytes()
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                some = b.slice(k, SLICE)
                for doc, ids in zip(some.column(0).to_pylist(), map(enc.ids, some.column(1).to_pylist()), strict=True):
                    yield from out.add(doc, ids + last, len(ids) // enc.kind.itemsize + 1)
        if out.keys:
            yield out.flush()

    rows.mapInArrow(run, SHARDS).write.parquet(f"{path}/shards")
    sums = spark.read.schema(SHARDS).parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote, no more
    sums.select("part", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")).write.parquet(f"{path}/parts")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with `start`, the ids of all shards before; `parts` has one row for each task that wrote."""
    parts = spark.read.schema("part int, n_ids long, base long").parquet(f"{path}/parts").select("part", "base")
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards").join(F.broadcast(parts), "part")
    return shards.withColumn("start", F.col("base") + F.col("at")).drop("base", "at")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (array<int>) of each document of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _documents(row, grammar(row).ids(), row["doc_ids"], np.array([0, *row["doc_ends"]], np.int64), ids=True)

    return _shards(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers) of each document of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _documents(row, grammar(row).ids(), row["doc_ids"], np.array([0, *row["doc_ends"]], np.int64), ids=False)

    return _shards(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, path: str, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """As read(), for the documents whose key is in `wanted` (repeated keys count once, null is none) only.

    The small columns of all shards are read to find the places; of a shard only the symbols that cover a wanted
    document are expanded.
    """
    keys = wanted.select(F.col(key).cast("long").alias("doc")).where("doc IS NOT NULL").distinct()
    places = _shards(spark, path).select("part", "shard", F.posexplode("doc_ids").alias("place", "doc"))
    places = places.join(keys, "doc", "left_semi").groupBy("part", "shard").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            g, edges = grammar(row), np.array([0, *row["doc_ends"]], np.int64)
            ends = g.ends()
            for k in row["places"]:
                ids = g.stretch(int(edges[k]), int(edges[k + 1]), ends)
                yield _documents(row | {"start": row["start"] + int(edges[k])}, ids, [row["doc_ids"][k]], np.array([0, len(ids)]), ids=True)

    return _shards(spark, path).join(places, ["part", "shard"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches, one at a time."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _documents(row: dict, found: np.ndarray, keys: list, edges: np.ndarray, ids: bool) -> pa.RecordBatch:
    """Documents with their ids or the checksum of them; `edges` are their bounds in `found`."""
    found = found.astype("<i4")
    if ids:
        last = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(found))
    else:
        data, at = found.data, edges.tolist()
        last = pa.array([zlib.crc32(data[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.int64())
    columns = [pa.array(keys, pa.int64()), pa.array(row["start"] + edges[:-1]), pa.array(np.diff(edges)), last]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids" if ids else "ids_crc32"])
