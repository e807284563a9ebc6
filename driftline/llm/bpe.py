"""Operator 1: byte-pair encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token is a certain cut: no merge can ever span it. Each
pre-token is cut there, the fragments are encoded on their own, and their ids are concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from driftline.llm.common import unused

#: The pre-tokenizer pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as Unicode lists it; Python's own \s also counts the separators U+001C to U+001F.
_PATTERN = PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
#: Pre-tokens kept encoded in each worker; the memory of a worker is bounded by it.
CACHE = 200_000
#: Rows that encode() handles at once.
SLICE = 256
#: Ranks behind every merge.
NONE = (1 << 60, -1)
#: Longer pre-tokens are not worth keeping.
CACHED_CHARS = 40


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    """A byte-level BPE vocabulary; small enough (tens of thousands of entries) to broadcast."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_chars()
        raw = lambda t: bytes(to_byte[c] for c in t)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.single = [vocab.get(bytes([b]), -1) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            a, b = raw(a), raw(b)
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        inside = bytearray(65536)
        for t in vocab:
            for a, b in zip(t, t[1:], strict=False):
                inside[a << 8 | b] = 1
        self.inside = bytes(inside)

    def fragments(self, data: bytes) -> list[bytes]:
        """data, cut at each byte pair that no token contains."""
        cuts = [k for k in range(1, len(data)) if not self.inside[data[k - 1] << 8 | data[k]]]
        return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)] if data else []

    def merge(self, data: bytes) -> list[int]:
        """The ids of one fragment: merge the pair of lowest rank, leftmost first, while there is one."""
        ids, merges = [self.single[b] for b in data], self.merges
        if len(ids) > 48:
            return self._merge_long(ids)
        ranks = [merges.get(pair, NONE) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) is not NONE:
            k = ranks.index(best)
            ids[k : k + 2] = [best[1]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = merges.get((ids[k], ids[k + 1]), NONE)
            if k:
                ranks[k - 1] = merges.get((ids[k - 1], ids[k]), NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list: n log n for fragments of any length."""
        n, merges = len(ids), self.merges
        after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def push(a: int) -> None:
            b = after[a]
            if b >= 0 and (m := merges.get((ids[a], ids[b]))):
                heapq.heappush(heap, (m[0], a, ids[a], ids[b], m[1]))

        for k in range(n - 1):
            push(k)
        while heap:
            _, a, left, right, new = heapq.heappop(heap)
            b = after[a] if alive[a] else -1
            if b < 0 or ids[a] != left or ids[b] != right:
                continue
            ids[a], alive[b], after[a] = new, False, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            push(a)
            if before[a] >= 0:
                push(before[a])
        return [x for x, keep in zip(ids, alive, strict=True) if keep]

    def encode_pretoken(self, text: str) -> list[int]:
        return [i for part in self.fragments(text.encode()) for i in self.merge(part)]

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(whether it is a special token, the stretch of text), in order."""
        if not any(s in text for s in self.special):
            yield False, text
            return
        for part in regex.split("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")", text):
            if part:
                yield part in self.special, part


class Encoder:
    """A worker's encoder: pre-tokens seen before are looked up."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe, self.find = bpe, regex.compile(_PATTERN).findall
        encode = bpe.encode_pretoken

        class Cache(dict):
            def __missing__(self, text: str) -> str:
                ids = ",".join(map(str, encode(text)))
                if len(text) <= CACHED_CHARS:
                    if len(self) >= CACHE:
                        self.clear()
                    self[text] = ids
                return ids

        class Counts(dict):
            def __missing__(self, text: str) -> int:
                n = 1 if text in bpe.special else len(encode(text))
                if len(text) <= CACHED_CHARS:
                    if len(self) >= CACHE:
                        self.clear()
                    self[text] = n
                return n

        self.cache, self.counts = Cache(), Counts()
        self.bytes_of = {str(i): t for i, t in bpe.token.items()}

    def ids(self, text: str) -> str:
        """The ids of a whole text, in decimal, joined by commas."""
        out = []
        for special, part in self.bpe.pieces(text):
            out.append(str(self.bpe.special[part]) if special else ",".join(map(self.cache.__getitem__, self.find(part))))
        return ",".join(out)

    def decode(self, ids: str) -> str:
        """The text of ids as ids() writes them; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


_ENCODERS: dict[int, Encoder] = {}


def encoder(shared) -> Encoder:
    """The encoder of this Python worker for a broadcast vocabulary."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def encode(spark: SparkSession, docs: DataFrame, tokenizer_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with a column of token ids (array<int>) of each whole text, the last one.

    Special tokens in a text become their ids, as the tokenizers library does. A null text counts as
    empty, an empty one has no ids; repeated rows are encoded each; other columns pass unchanged, an
    existing column named `out` is replaced. One pass, no shuffle; nothing is cut off. A worker holds the ids of SLICE
    rows at once.
    """
    shared = spark.sparkContext.broadcast(Bpe(tokenizer_path))
    rest = docs.drop(out)
    whole = rest.withColumn(unused(rest, "text"), F.col(text))  # the text under a name of its own, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared)
        for b in batches:
            for first in range(0, b.num_rows, SLICE):
                part = b.slice(first, SLICE)
                ids = [np.fromstring(enc.ids(t or ""), np.int32, sep=",") for t in part.column(part.num_columns - 1).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], out])

    return whole.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(spark: SparkSession, df: DataFrame, tokenizer_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text of a column of token ids; null or empty ids give the empty text.

    An id that the vocabulary lacks fails the job: it can't be decoded.
    """
    shared = spark.sparkContext.broadcast(Bpe(tokenizer_path))

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        enc = encoder(shared)
        return pd.Series([enc.decode(",".join(map(str, r))) if r is not None else "" for r in rows], dtype=object)

    return df.withColumn(out, run(F.col(ids)))


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digest of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are decoded again from their decimal form, in the same pass. Nulls and empty texts as in encode().
    """
    shared = spark.sparkContext.broadcast(Bpe(tokenizer_path))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        enc, rows = encoder(shared), []
        for t in texts:
            ids = enc.ids(t or "")
            rows.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(enc.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
