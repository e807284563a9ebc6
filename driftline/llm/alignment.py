"""Operator 13: alignment of the tokens of two tokenizers.

Each task encodes its texts with both, puts the tokens as byte intervals into DuckDB tables (all texts of a portion
one behind the other, so an offset belongs to one text) and joins them there: equal ends link tokens and cut groups,
window sums number the groups, ASOF joins find the group or the overlapping tokens of each interval. The pairs of a
block are counted there and merged in Spark; what they amount to comes back to the blocks by a join.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from driftline.llm.bpe import _PATTERN, byte_chars
from driftline.llm.common import cut, portions

#: Characters of text whose pairs are counted together before they leave a task.
BLOCK = 1 << 21
#: Bytes of blocks that Spark writes, and so reads, at once; left to itself it gathers 100 blocks before it looks.
GATHERED = 1 << 22
#: Characters of text that are joined in DuckDB at once; a longer text is a portion of its own.
PORTION = 1 << 18
#: Pre-tokens that a worker remembers in a generation, and the longest of them.
CACHE, CACHED_CHARS = 150_000, 40
#: What a worker's DuckDB may take for one portion, at most; a usual one takes some 50 MB.
MEMORY = "2GB"

BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "pair_a array<int>, pair_b array<int>, pair_n array<long>, links binary"
)


def _splitter() -> Callable[[str], list[str]]:
    """Pre-tokens of a text, as _PATTERN finds them.

    Its classes are listed for the characters of one plane, of which Python's own expressions look up a character at
    once; a text with others is left to the regex library, which takes twice the time.
    """
    plane = "".join(map(chr, range(0x10000)))
    listed = lambda name: "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in regex.findall(rf"\p{{{name}}}+", plane))
    letter, number, white = listed("L"), listed("N"), listed("White_Space")
    pattern = _PATTERN.replace(r"\p{White_Space}\p{L}\p{N}", white + letter + number)
    for name, chars in ((r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\p{White_Space}", f"[{white}]"), (r"\P{White_Space}", f"[^{white}]")):
        pattern = pattern.replace(name, chars)
    in_plane, any_text, beyond = re.compile(pattern).findall, regex.compile(_PATTERN).findall, re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: any_text(text) if beyond(text) else in_plane(text)


class _ByteLevel(dict):
    """Ids of pre-tokens of a byte-level BPE, special tokens taken as plain text; two generations of CACHE are remembered."""

    def __init__(self, data: bytes) -> None:
        super().__init__()
        tokenizer = Tokenizer.from_buffer(data)
        self.model, self.find, self.old = tokenizer.model, _splitter(), {}
        of = byte_chars()
        self.char = {b: c for c, b in of.items()}
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        vocab = {t: i for t, i in tokenizer.get_vocab().items() if t not in special}
        if any(c not in vocab for c in of):
            raise ValueError("a byte has no token, so texts can't be read back")
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(map(of.__getitem__, t))

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word[1:].isalnum() and word[0] == " ":
                chars = self.char[32] + word[1:]  # printable ASCII stands for itself
            else:
                chars = "".join(map(self.char.__getitem__, word.encode()))
            ids = array("i", [t.id for t in self.model.tokenize(chars)]).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.find(text))), np.int32)


class _Pieces:
    """A sentencepiece model; it sets a space before the text itself."""

    def __init__(self, data: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = self.model.get_piece_size()
        raw = lambda i: bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
        self.bytes_of = [raw(i) for i in range(n)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers of a worker and its DuckDB."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = _ByteLevel(a), _Pieces(b)
        self.size_a, self.size_b = (np.array([len(t) for t in x.bytes_of], np.int64) for x in (self.a, self.b))
        text = [str(i).encode() for i in range(max(len(self.size_a), len(self.size_b)))]
        self.marked = np.array([[t + mark for t in text] for mark in (b",", b"|", b";", b"")], object)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": "", "preserve_insertion_order": False})

    def tokens(self, texts: list[str | None]) -> tuple[pa.Table, pa.Table]:
        """The intervals of both sides: doc (the place of the text), i, id, s, e (byte offsets in all texts joined)."""
        out: list[list[np.ndarray]] = [[], []]
        docs: list[list[np.ndarray]] = [[], []]
        ends: list[list[np.ndarray]] = [[], []]
        at = 0
        full = [(k, t) for k, t in enumerate(texts) if t]
        for (k, t), b in zip(full, self.b.ids([t for _, t in full]), strict=True):
            spaced = b" " + t.encode()
            if b"".join(map(self.b.bytes_of.__getitem__, b)) != spaced:
                continue
            for side, ids, size in ((0, self.a.ids(" " + t), self.size_a), (1, np.array(b, np.int32), self.size_b)):
                out[side].append(ids)
                docs[side].append(np.full(len(ids), k, np.int32))
                ends[side].append(at + np.cumsum(size[ids]))
            at += len(spaced)
        none = [np.zeros(0, np.int32)]
        tables = []
        for side, size in ((0, self.size_a), (1, self.size_b)):
            ids, end = np.concatenate(out[side] or none), np.concatenate(ends[side] or none).astype(np.int64)
            cells = {"doc": np.concatenate(docs[side] or none), "i": np.arange(len(ids), dtype=np.int32), "id": ids, "s": end - size[ids], "e": end}
            tables.append(pa.table(cells))
        return tables[0], tables[1]

    def sql(self, query: str, **tables: pa.Table) -> pa.Table:
        for name, t in tables.items():
            self.db.register(name, t)
        try:
            return self.db.sql(query).to_arrow_table()
        finally:
            for name in tables:
                self.db.unregister(name)

    def linked(self, a: pa.Table, b: pa.Table) -> pa.Table:
        """doc, a, b, e of each link: tokens whose ranges end together at e; in the order of g, the group that ends there.

        Tokens have bytes, so no two of a side end together: the number of a group is the sum of the links before.
        """
        query = "SELECT a.doc, a.id AS a, b.id AS b, a.e, (sum(1) OVER (ORDER BY a.e ROWS UNBOUNDED PRECEDING) - 1)::INT AS g FROM a JOIN b ON a.e = b.e"
        found = self.sql(query, a=a.select(["doc", "id", "e"]), b=b.select(["id", "e"]))
        place = np.empty(found.num_rows, np.int64)
        place[found["g"].to_numpy()] = np.arange(found.num_rows)
        return found.take(pa.array(place))

    def groups(self, tokens: pa.Table, links: pa.Table) -> np.ndarray:
        """The group of each token: the one of the first cut at its end or behind it."""
        query = "SELECT t.i, c.g FROM t ASOF JOIN c ON t.e <= c.e"
        found = self.sql(query, t=tokens.select(["i", "e"]), c=links.select(["e", "g"]))
        out = np.zeros(tokens.num_rows, np.int32)
        out[found["i"].to_numpy()] = found["g"].to_numpy()
        return out

    def overlapping(self, a: pa.Table, b: pa.Table) -> pa.Table:
        """doc, a_i, a, b_i, b, bytes of each two tokens whose ranges overlap: a range of A tokens for each B token, found by two ASOF joins."""
        return self.sql(
            """
            WITH firsts AS (SELECT b.*, a.i AS low FROM b ASOF JOIN a ON b.s >= a.s),
                 ranges AS (SELECT f.*, a.i AS high FROM firsts f ASOF JOIN a ON f.e > a.s)
            SELECT r.doc, a.i AS a_i, a.id AS a, r.i AS b_i, r.id AS b, least(a.e, r.e) - greatest(a.s, r.s) AS bytes
            FROM ranges r JOIN a ON a.i BETWEEN r.low AND r.high ORDER BY a_i, b_i
            """,
            a=a,
            b=b,
        )

    def digests(self, n: int, a: pa.Table, b: pa.Table, links: pa.Table) -> list[str]:
        """The digest of the groups of each of n texts; '' without tokens."""
        out = [""] * n
        if not links.num_rows:
            return out
        g_a, g_b = self.groups(a, links), self.groups(b, links)
        in_a, in_b = np.bincount(g_a), np.bincount(g_b)
        at_a = np.arange(len(g_a)) + (np.cumsum(in_b) - in_b)[g_a]  # behind the B tokens of the groups before
        at_b = np.arange(len(g_b)) + np.cumsum(in_a)[g_b]  # behind the A tokens of the groups up to its own
        ids, mark = np.empty(len(g_a) + len(g_b), np.int64), np.zeros(len(g_a) + len(g_b), np.int8)
        ids[at_a], ids[at_b] = a["id"].to_numpy(), b["id"].to_numpy()
        ends = np.cumsum(in_a + in_b)
        mark[ends - in_b - 1] = 1
        mark[ends - 1] = 2
        doc = np.empty(len(ends), np.int64)
        doc[g_a] = a["doc"].to_numpy()
        last = np.append(np.diff(doc) != 0, True)
        mark[ends[last] - 1] = 3
        cells, first = self.marked[mark, ids].tolist(), 0
        for k, end in zip(doc[last].tolist(), ends[last].tolist(), strict=True):
            out[k] = hashlib.sha256(b"".join(cells[first:end])).hexdigest()
            first = end
        return out


_ALIGNERS: dict[int, Aligner] = {}


def aligner(shared) -> Aligner:
    """The aligner of this Python worker for two broadcast tokenizer files."""
    key = id(shared.value)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*shared.value)
    return _ALIGNERS[key]


def _broadcast(spark: SparkSession, a_path: str, b_path: str):
    """The bytes of both files (a few MB whatever the corpus), so that executors need not have them."""
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            contents.append(f.read())
    return spark.sparkContext.broadcast(tuple(contents))


class _Pairs:
    """Numbers for the pairs of a block and how often each is linked."""

    def __init__(self) -> None:
        self.links: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.links.append(a.astype(np.int64) << 32 | b)

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        places, keys = pd.factorize(np.concatenate(self.links) if self.links else np.zeros(0, np.int64))
        n = np.bincount(places, minlength=len(keys))
        return (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n, _packed(places, len(keys))


def _kind(n: int) -> type:
    """The numbers that n places need."""
    return np.uint16 if n <= 1 << 16 else np.int32


def _packed(places: np.ndarray, n: int) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(places.astype(_kind(n)))


def _places(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), _kind(n))


def blocks(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """BLOCKS: texts of about BLOCK characters each, with their counts, the distinct linked pairs and all links as places among those."""
    shared = _broadcast(spark, a_path, b_path)

    kinds = {"doc_ids": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "pair_a": pa.int32(), "pair_b": pa.int32(), "pair_n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, seq, part = aligner(shared), 0, TaskContext.get().partitionId()
        for batch in batches:
            for big in _cut_up(batch, BLOCK):
                cells: dict[str, list] = {c: [] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                pairs = _Pairs()
                for some in _cut_up(big, PORTION):
                    n = some.num_rows
                    a, b = al.tokens(some.column(1).to_pylist())
                    links = al.linked(a, b)
                    pairs.add(links["a"].to_numpy(), links["b"].to_numpy())
                    cells["doc_ids"] += some.column(0).to_pylist()
                    cells["groups_sha256"] += al.digests(n, a, b, links)
                    for name, t in (("n_a", a), ("n_b", b), ("n_links", links), ("n_groups", links)):
                        cells[name] += np.bincount(t["doc"].to_numpy(), minlength=n).tolist()
                pair_a, pair_b, pair_n, places = pairs.close()
                row = cells | {"pair_a": pair_a, "pair_b": pair_b, "pair_n": pair_n}
                columns = [pa.array([part << 32 | seq]), *(pa.array([row[c]], pa.list_(t)) for c, t in kinds.items()), pa.array([places], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", *kinds, "links"])
                seq += 1
                pa.default_memory_pool().release_unused()

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, BLOCKS)


def _cut_up(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` bytes of text, the second column; a longer text is a slice of its own."""
    portion = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    edges = [0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), batch.num_rows]
    for first, end in zip(edges, edges[1:], strict=False):
        if end > first:
            yield batch.slice(first, end - first)


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b, count (links corpus-wide that hold the pair), best (no pair of this b has more) from blocks()."""
    each = found.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p"))
    counts = each.groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b")).agg(F.sum("p.pair_n").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    A text that is null or empty, or that a tokenizer does not give back byte by byte (with a space before it), has no
    tokens: zeros and ''. Null keys stay null; repeated rows count each; an empty table gives no rows; other columns
    are ignored. A block goes back to its documents with the counts of its own distinct pairs only.
    """
    found = cut(blocks(spark, docs, a_path, b_path, key, text), GATHERED)
    counts = cut(pair_counts(found))
    places = found.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("at", "p")).select("block", "at", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    known = places.join(counts, ["a", "b"]).select(F.col("block").alias("of"), "at", "count", "best")
    rows = found.select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")

    def run(block: pa.Table, pairs: pa.Table) -> pa.Table:
        _ALIGNERS.clear()  # what this worker has tokenized with before is not needed any more
        flat = {c: block.column(c).combine_chunks().flatten() for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        links, sizes = _places(block.column("links")[0].as_py(), pairs.num_rows), flat["n_links"].to_numpy()
        ends, at = np.append(0, np.cumsum(sizes)), pairs["at"].to_numpy()

        def total(column: str) -> pa.Array:
            by_place = np.zeros(pairs.num_rows, np.int64)
            by_place[at] = pairs[column].to_numpy()
            return pa.array(np.diff(np.append(0, np.cumsum(by_place[links]))[ends]))

        columns = [*(flat[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), total("best"), total("count"), flat["groups_sha256"]]
        return pa.table(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, schema)


def overlaps(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a_i, a, b_i, b, bytes: each two tokens of a text (place and id) that share bytes, and how many.

    Places count from the first token of the text; texts without tokens, as in align(), give no rows.
    """
    shared = _broadcast(spark, a_path, b_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        al = aligner(shared)
        for batch in batches:
            for some in portions(batch, "text", PORTION):
                a, b = al.tokens(list(some["text"]))
                rows = al.overlapping(a, b).to_pandas()
                for side, t in (("a_i", a), ("b_i", b)):
                    first = pd.Series(t["i"].to_numpy()).groupby(t["doc"].to_numpy()).min()
                    rows[side] = rows[side] - rows["doc"].map(first)
                ids = pd.array([None if late else int(i) for late, i in zip(some["late"], some["id"], strict=True)], "Int64")
                rows["doc_id"] = ids[rows["doc"].to_numpy(np.int64)]
                yield rows[["doc_id", "a_i", "a", "b_i", "b", "bytes"]]

    rows = docs.select(F.col(key).isNull().alias("late"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, a_i long, a int, b_i long, b int, bytes long")
