"""Operator 2: removal of repeated passages by a De Bruijn graph of words.

The edges of the graph are the windows of 20 words, each from its first 19 words to its last 19. Edges are dealt by
anchors: the anchor of an edge is the least hash of a run of 8 words in it, so equal edges have equal anchors.
Consecutive edges of a document that share the place of their anchor are one piece, a path of the graph inside one
bucket. Then, all by Spark joins:

1. Anchors that occur once hold no repeated edge; only the others go on.
2. Equal pieces meet. A bucket with one kind of piece does not branch: its later pieces repeat the first one whole.
3. In a bucket that branches, the first piece of each kind is taken apart into edges, and equal edges meet.
4. Pieces and edges that repeat consecutive places of one source join across bucket borders into paths.

Pieces and edges are told apart by 128 bits of a BLAKE2b digest of their words, read at their coordinates in the document
and in the source; the cheap hashes of anchors decide nothing. verify_paths() compares the words themselves.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from driftline.llm.common import Members, cut, identity, packed_texts, portions, row_of, spent, unpacked
from driftline.llm.hashing import run_hashes, word_hashes

WINDOW, ANCHOR = 20, 8
#: Bits of an anchor. Two runs of words that share one by chance only cost time.
ANCHOR_BITS = 48
_PATHS = "array<struct<start:int,length:int,source:long,source_start:int>>"


def pieces_of(hashes: np.ndarray, window: int = WINDOW, bits: int = ANCHOR_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of each piece of a document, from the hashes of its words."""
    size = min(ANCHOR, window)
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none
    runs = (run_hashes(hashes, size) & np.uint64((1 << bits) - 1)).view(np.int64)
    at = np.lib.stride_tricks.sliding_window_view(runs, window - size + 1).argmin(1) + np.arange(len(hashes) - window + 1)
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return runs[at[start]], start, np.diff(np.append(start, len(at)))


def digest(words: list[bytes]) -> tuple[int, int]:
    """128 bits of a sequence of words, as two numbers."""
    return struct.unpack("<qq", blake2b(b" ".join(words), digest_size=16).digest())


def anchors(docs: DataFrame, text: str, key: str, window: int, bits: int) -> DataFrame:
    """anchor, row, n: how many pieces of the document have this anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "text"):
                found = [np.unique(pieces_of(h, window, bits)[0], return_counts=True) for h in word_hashes((t or "").encode() for t in part["text"])]
                yield pd.DataFrame({
                    "anchor": np.concatenate([u for u, _ in found]),
                    "row": np.repeat(part["row"].to_numpy(), [len(u) for u, _ in found]),
                    "n": np.concatenate([n for _, n in found]),
                })

    rows = docs.select(row_of(key, text).alias("row"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "anchor long, row long, n long")


def repeated_pieces(marked: DataFrame, window: int, bits: int) -> DataFrame:
    """anchor, p1, p2 (digest), late, id, row, start, n: the pieces of each packed text whose anchor is in its column anchors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "packed", 1 << 18):
                out = []
                texts = list(unpacked(part["packed"]))
                for late, key, row, again, data, h in zip(part["late"], part["id"], part["row"], part["anchors"], texts, word_hashes(iter(texts)), strict=True):
                    anchor, start, n = pieces_of(h, window, bits)
                    hit = np.isin(anchor, again)
                    if hit.any():
                        words = data.split()
                        out += [(a, *digest(words[s : s + k + window - 1]), late, key, row, s, k) for a, s, k in zip(anchor[hit].tolist(), start[hit].tolist(), n[hit].tolist(), strict=True)]
                yield pd.DataFrame(out, columns=["anchor", "p1", "p2", "late", "id", "row", "start", "n"])

    return marked.select("late", "id", "row", "packed", "anchors").mapInPandas(run, "anchor long, p1 long, p2 long, late boolean, id long, row long, start int, n int")


def edges_of(marked: DataFrame, window: int) -> DataFrame:
    """e1, e2 (digest), late, id, row, start: the single windows of the pieces (start, n) that column pieces lists for each packed text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "packed", 1 << 18):
                out = []
                for late, key, row, listed, data in zip(part["late"], part["id"], part["row"], part["pieces"], unpacked(part["packed"]), strict=True):
                    words = data.split()
                    out += [(*digest(words[k : k + window]), late, key, row, k) for p in listed for k in range(p["start"], p["start"] + p["n"])]
                yield pd.DataFrame(out, columns=["e1", "e2", "late", "id", "row", "start"])

    return marked.select("late", "id", "row", "packed", "pieces").mapInPandas(run, "e1 long, e2 long, late boolean, id long, row long, start int")


def placed(found: DataFrame) -> DataFrame:
    """found with `at`: struct<late, id, row, start>, the order in which windows are earlier or later (a null id last)."""
    return found.withColumn("at", F.struct("late", "id", "row", "start"))


def repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", bits: int = ANCHOR_BITS) -> DataFrame:
    """row, paths: of each row of docs that repeats something, the paths to remove, array<struct<start, length, source, source_start>>.

    Words `start` to `start + length` of the row are the words of the document `source` from `source_start` on (both
    from 0), which is earlier. Paths may overlap by less than a window.
    """
    found = cut(anchors(docs, text, key, window, bits))
    again = found.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    marks = cut(found.select("anchor", "row").join(again, "anchor").groupBy("row").agg(F.collect_list("anchor").alias("anchors")))
    spent(found)
    pieces = cut(repeated_pieces(packed_texts(docs, marks, key, text).dropDuplicates(["row"]).join(marks, "row"), window, bits))
    spent(marks)

    kinds = cut(placed(pieces).groupBy("anchor", "p1", "p2").agg(F.min("at").alias("source"), F.max("n").alias("n"), F.count("*").alias("times")))
    branching = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    apart = kinds.join(branching, "anchor", "left_semi").select("source.row", F.struct("source.start", "n").alias("piece"))
    apart = cut(apart.groupBy("row").agg(F.collect_list("piece").alias("pieces")))
    edges = cut(edges_of(packed_texts(docs, apart, key, text).dropDuplicates(["row"]).join(apart, "row"), window))
    first = placed(edges).groupBy("e1", "e2").agg(F.min("at").alias("source"), F.count("*").alias("times")).where("times > 1")

    other = (F.col("row") != F.col("source.row")) | (F.col("start") != F.col("source.start"))
    from_edges = edges.join(first, ["e1", "e2"]).where(other).select("row", "start", F.lit(1).alias("n"), "source")
    from_pieces = pieces.join(kinds.where("times > 1").drop("n", "times"), ["anchor", "p1", "p2"]).where(other).select("row", "start", "n", "source")
    hits = cut(from_pieces.unionByName(from_edges).distinct())
    spent(pieces, kinds, apart, edges)

    in_order = Window.partitionBy("row").orderBy("start")
    before = lambda c: F.lag(c).over(in_order)
    goes_on = (F.col("start") == before("start") + before("n")) & (F.col("source.row") == before("source.row")) & (F.col("source.start") == before("source.start") + before("n"))
    paths = hits.withColumn("begins", F.when(goes_on, 0).otherwise(1)).withColumn("path", F.sum("begins").over(in_order))
    paths = paths.groupBy("row", "path").agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.min(F.struct("start", "source")).alias("first"))
    path = F.struct("start", (F.col("n") + window - 1).cast("int").alias("length"), F.when(~F.col("first.source.late"), F.col("first.source.id")).alias("source"), F.col("first.source.start").alias("source_start"))
    return paths.groupBy("row").agg(F.sort_array(F.collect_list(path)).alias("paths"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id", bits: int = ANCHOR_BITS) -> DataFrame:
    """key, n_words, n_removed, kept (the words left, joined by one space), paths (see repeats()).

    A word goes if a window that covers it repeats an earlier one: of a smaller key, or earlier in the same
    document; windows are those of the input. A null text has no words; texts shorter than a window keep all. Rows with
    a null key come last. Of rows that share a key (or have none) but not the text, the one with the smaller hash of key
    and text is the earlier; equal rows are one document that is returned as often, none of them earlier. Whole texts of
    any length; an empty table gives none. Other columns are not carried along: join by key.
    """
    spark = docs.sparkSession
    paths = cut(repeats(docs, window, text, key, bits))
    members = spark.sparkContext.broadcast(Members(paths))
    result = f"late boolean, id long, n_words long, n_removed long, kept string, paths {_PATHS}"

    def removed(part: pd.DataFrame, texts: Iterator[bytes], paths: list) -> pd.DataFrame:
        rows = []
        for late, key_value, data, spans in zip(part["late"], part["id"], texts, paths, strict=True):
            words = data.split()
            n, gone = len(words), 0
            if spans is not None and len(spans):
                keep = np.ones(n, bool)
                for s in spans:
                    keep[s["start"] : s["start"] + s["length"]] = False
                gone = int(n - keep.sum())
                words = [words[k] for k in np.flatnonzero(keep)]
            rows.append((late, key_value, n, gone, b" ".join(words).decode(), spans))
        return pd.DataFrame(rows, columns=["late", "id", "n_words", "n_removed", "kept", "paths"])

    def untouched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b[~members.value.hold(b["row"])], "text"):
                yield removed(part, ((t or "").encode() for t in part["text"]), [[] for _ in range(len(part))])

    def touched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "packed", 1 << 18):
                yield removed(part, unpacked(part["packed"]), list(part["paths"]))

    rest = docs.select(*identity(key, text), F.col(text).alias("text")).mapInPandas(untouched, result)
    some = packed_texts(docs, paths, key, text, members).join(paths, "row", "left").mapInPandas(touched, result)
    return rest.unionByName(some).select(F.when(~F.col("late"), F.col("id")).alias(key), "n_words", "n_removed", "kept", "paths")


def verify_paths(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, start, source, source_start of each path in found (remove_repeats()) whose words are not those at its source coordinates.

    None, if all is well. For tests and audits: docs needs unique keys. The texts of both ends meet by two joins.
    """
    words = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = docs.select(F.col(key).alias("k"), words(F.col(text)).alias("w"))
    each = found.select(F.col(key).alias("id"), F.explode("paths").alias("p")).select("id", "p.*")
    own = each.join(texts, F.col("id") == F.col("k")).select(each["*"], F.slice("w", F.col("start") + 1, F.col("length")).alias("own"))
    both = own.join(texts, F.col("source") == F.col("k")).withColumn("other", F.slice("w", F.col("source_start") + 1, F.col("length")))
    return both.where("own != other").select(F.col("id").alias(key), "start", "source", "source_start")
