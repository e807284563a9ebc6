"""Operator 4: token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree of token counts. Trees are kept in a table; an edit reads
that table alone, opens the leaves it touches, re-encodes the pre-tokens that can change, and updates the sums above.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.column import Column

from driftline.llm.bpe import CACHE, CACHED_CHARS, SLICE, Bpe, Encoder, byte_chars
from driftline.llm.common import unused

#: Pre-tokens in a leaf when the tree is built.
LEAF = 64

#: A kept tree: the root's sums, those of all nodes (node k has the children 2 k and 2 k + 1), and the leaves with the
#: length in characters and the count of tokens of each pre-token, packed.
LEAF_TYPE = "struct<text string, lengths binary, counts binary>"
TREE_TYPE = f"struct<n_chars long, n_tokens long, chars array<long>, tokens array<long>, leaves array<{LEAF_TYPE}>>"
COUNTS_TYPE = "n_tokens_before long, n_tokens_after long, n_chars_after long, n_reencoded long"

Leaf = tuple[str, bytes, bytes]


def pack(values: list[int]) -> bytes:
    """Numbers from 1 on, a byte each; after a zero byte four bytes each where one is above 255."""
    return bytes(values) if max(values, default=0) < 256 else b"\0" + np.array(values, "<u4").tobytes()


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4", offset=1).tolist() if packed[:1] == b"\0" else list(packed)


class Vocabulary(Bpe):
    """The vocabulary with the text of its file, of which a worker makes the library's model."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.spec = Path(path).read_text("utf-8")


class Counter(Encoder):
    """Cuts texts as the encoder does; a pre-token that was not met before is counted by the library's model."""

    def __init__(self, bpe: Vocabulary) -> None:
        super().__init__(bpe)
        model, char = tokenizers.Tokenizer.from_str(bpe.spec).model, {b: c for c, b in byte_chars().items()}

        class Counts(dict):
            def __missing__(self, text: str) -> int:
                n = 1 if text in bpe.special else len(model.tokenize(text.encode().decode("latin-1").translate(char)))
                if len(text) <= CACHED_CHARS:
                    if len(self) >= CACHE:
                        self.clear()
                    self[text] = n
                return n

        self.counts = Counts()


_COUNTERS: dict[int, Counter] = {}


def counter(shared) -> Counter:
    """The counter of this Python worker for a broadcast vocabulary."""
    key = id(shared.value)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(shared.value)
    return _COUNTERS[key]


class CountTree:
    """Leaves hold runs of pre-tokens with their counts; inner nodes hold sums of characters and tokens."""

    def __init__(self, text: str, enc: Counter) -> None:
        self._use(enc)
        pieces = self._split(text)
        self._plant(*self._deal(pieces, list(map(self.count, pieces)), -(-len(pieces) // LEAF)))

    @classmethod
    def kept(cls, enc: Counter, chars: list[int], tokens: list[int], leaves: list[int], stored: tuple[pa.Array, ...]) -> CountTree:
        """A tree from its table: `leaves` are places in the stored columns of leaves, read when an edit touches them."""
        tree = cls.__new__(cls)
        tree._use(enc)
        tree.chars, tree.tokens, tree.leaves, tree.stored = chars, tokens, leaves, stored
        tree.width = len(chars) // 2
        return tree

    def _use(self, enc: Counter) -> None:
        self.enc, self.count = enc, enc.counts.__getitem__
        self.reencoded, self.opened = 0, 0
        #: A pre-token depends on its own characters and two after it; a special token on its length.
        self.reach = max(map(len, enc.bpe.special), default=1) + 2

    def _split(self, text: str) -> list[str]:
        return [p for special, part in self.enc.bpe.pieces(text) for p in ([part] if special else self.enc.find(part))]

    @staticmethod
    def _deal(pieces: list[str], counts: list[int], n: int) -> tuple[list[Leaf], list[int], list[int]]:
        """Pre-tokens in n leaves (one at least), and the sums of each."""
        n = max(1, n)
        cuts = [k * len(pieces) // n for k in range(n + 1)]
        spans = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        texts = ["".join(pieces[s]) for s in spans]
        leaves = [(t, pack(list(map(len, pieces[s]))), pack(counts[s])) for t, s in zip(texts, spans, strict=True)]
        return leaves, list(map(len, texts)), [sum(counts[s]) for s in spans]

    def _plant(self, leaves: list, chars: list[int], tokens: list[int]) -> None:
        """All sums from those of the leaves; no leaf is opened."""
        self.leaves, self.width = leaves, 1 << (len(leaves) - 1).bit_length()
        empty = [0] * (self.width - len(leaves))
        self.chars, self.tokens = [0] * self.width + chars + empty, [0] * self.width + tokens + empty
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k], self.tokens[k] = (x[2 * k] + x[2 * k + 1] for x in (self.chars, self.tokens))

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def leaf(self, k: int) -> Leaf:
        """Text, lengths and counts of a leaf, packed as they are kept."""
        x = self.leaves[k]
        return x if isinstance(x, tuple) else tuple(column[x].as_py() for column in self.stored)

    def _open(self, first: int, end: int) -> tuple[list[str], list[int]]:
        """The pre-tokens of leaves and their counts."""
        pieces, counts = [], []
        for k in range(first, min(end, len(self.leaves))):
            text, lengths, packed = self.leaf(k)
            at = 0
            for n in unpack(lengths):
                pieces.append(text[at : at + n])
                at += n
            counts += unpack(packed)
            self.opened += 1
        return pieces, counts

    def text(self) -> str:
        return "".join(self.leaf(k)[0] for k in range(len(self.leaves)))

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at` (the last one past the end), and where it starts."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if at >= start + self.chars[k] and start + self.chars[k] < self.n_chars:
                start, k = start + self.chars[k], k + 1
        return min(k - self.width, len(self.leaves) - 1), start

    def _after(self, k: int) -> str:
        """As much of the text from leaf k on as decides how the text before it is cut."""
        out = ""
        while k < len(self.leaves) and len(out) < self.reach:
            out += self.leaf(k)[0]
            k += 1
        return out

    def edit(self, start: int, length: int, new: str) -> None:
        """Replace `length` characters from `start` by `new`; both are clipped to the text."""
        start = max(0, min(start, self.n_chars))
        end = max(start, min(start + length, self.n_chars))
        a, keep = self._leaf_at(max(0, start - self.reach))
        b = self._leaf_at(end)[0] + 1
        old, counts = self._open(a, b)
        head = 0
        while head < len(old) and keep + len(old[head]) + self.reach <= start:
            keep += len(old[head])
            head += 1
        flat = "".join(old[head:])
        edited = flat[: start - keep] + new + flat[end - keep :]
        same = start - keep + len(new)  # from here on the text is the old one
        # New pre-tokens are cut until one starts where an old one did, after the edit; the rest stays.
        begins, at = {}, len(edited) - len(flat)
        for k in range(head, len(old)):
            begins[at] = k
            at += len(old[k])
        more = 1
        while True:
            whole, done, pos, rest = edited + self._after(b), [], 0, None
            for p in self._split(whole):
                if pos >= same and pos in begins and self._safe(whole, pos):
                    rest = begins[pos]
                    break
                done.append(p)
                pos += len(p)
            if rest is not None or b >= len(self.leaves):
                break
            # Twice as many leaves each time, so that a pre-token over many of them is cut a few times only.
            pieces, n = self._open(b, b + more)
            for k, p in enumerate(pieces, len(old)):
                begins[at] = k
                at += len(p)
            old, counts, edited = old + pieces, counts + n, edited + "".join(pieces)
            b, more = min(b + more, len(self.leaves)), 2 * more
        self.reencoded += len(done)
        rest = len(old) if rest is None else rest
        self._replace(a, b, old[:head] + done + old[rest:], counts[:head] + list(map(self.count, done)) + counts[rest:])

    def _safe(self, whole: str, pos: int) -> bool:
        """Whether no special token spans pos."""
        return not any(whole.find(s, max(0, pos - len(s) + 1), pos + len(s) - 1) >= 0 for s in self.enc.bpe.special)

    def _replace(self, a: int, b: int, pieces: list[str], counts: list[int]) -> None:
        """Put the pre-tokens into leaves a to b: as many as before, with the sums above them, unless they are too full or too empty."""
        n = b - a
        fits = n * LEAF // 4 <= len(pieces) <= 4 * LEAF * n or n == len(self.leaves) == 1 and len(pieces) <= LEAF
        leaves, chars, tokens = self._deal(pieces, counts, n if fits else -(-len(pieces) // LEAF))
        if len(leaves) != n:
            w, m = self.width, len(self.leaves)
            side = lambda x, put: x[w : w + a] + put + x[w + b : w + m]
            self._plant(self.leaves[:a] + leaves + self.leaves[b:], side(self.chars, chars), side(self.tokens, tokens))
            return
        first = self.width + a
        self.leaves[a:b], self.chars[first : first + n], self.tokens[first : first + n] = leaves, chars, tokens
        low, high = first >> 1, (first + n - 1) >> 1
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low >> 1, high >> 1


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for row in rows for x in row], kind))


def _table(trees: list[CountTree]) -> pa.StructArray:
    """Trees as they are kept."""
    leaves = [[t.leaf(k) for k in range(len(t.leaves))] for t in trees]
    flat = [x for row in leaves for x in row]
    kinds = [("text", pa.string()), ("lengths", pa.binary()), ("counts", pa.binary())]
    packed = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])
    ends = pa.array(np.cumsum([0, *map(len, leaves)]).astype(np.int32))
    roots = [pa.array([getattr(t, name) for t in trees], pa.int64()) for name in ("n_chars", "n_tokens")]
    sums = [_lists([getattr(t, name) for t in trees], pa.int64()) for name in ("chars", "tokens")]
    return pa.StructArray.from_arrays([*roots, *sums, pa.ListArray.from_arrays(ends, packed)], ["n_chars", "n_tokens", "chars", "tokens", "leaves"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first in range(0, b.num_rows, SLICE):
            yield b.slice(first, SLICE)


def build(spark: SparkSession, docs: DataFrame, tokenizer_path: str, text: str = "text", tree: str = "tree") -> DataFrame:
    """docs with the tree of each whole text in place of the text: what keep() writes. One pass, no shuffle.

    A null text counts as empty and has a tree of one empty leaf. Repeated rows and null keys have a tree each; other
    columns pass unchanged, an existing column named `tree` is replaced. A text of any length is one row, as in docs.
    """
    shared = spark.sparkContext.broadcast(Vocabulary(tokenizer_path))
    rest = docs.drop(tree, text)
    whole = docs.select(*(docs[c] for c in rest.columns), docs[text].alias(unused(rest, "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = counter(shared)
        for b in _slices(batches):
            trees = [CountTree(t or "", enc) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _table(trees)], [*b.schema.names[:-1], tree])

    return whole.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(tree, T._parse_datatype_string(TREE_TYPE))]))


def keep(trees: DataFrame, path: str) -> DataFrame:
    """Write trees to a new folder that all executors share, and read them from there."""
    trees.write.option("compression", "zstd").parquet(path)
    return trees.sparkSession.read.schema(trees.schema).parquet(path)


def edit(
    spark: SparkSession, trees: DataFrame, tokenizer_path: str, edits: str = "edits", tree: str = "tree", counted: str = "counted", grown: bool = True
) -> DataFrame:
    """trees, without `edits`, after their edits: the new tree, and counted (n_tokens_before, n_tokens_after, n_chars_after, n_reencoded).

    `edits` is array<struct<start int, length int, new string>>, applied in order, in code points of the text as it
    then stands. Null edits, or a null one, change nothing; a null `new` inserts nothing; an edit outside the text is
    clipped to it. n_reencoded counts the pre-tokens encoded again; all other counts come from the kept leaves and sums.
    Without `grown` the new trees are left out. A row whose tree is null gives null counts.
    """
    shared = spark.sparkContext.broadcast(Vocabulary(tokenizer_path))
    rest = trees.drop(edits, tree, counted)
    rows = trees.select(*(trees[c] for c in rest.columns), trees[edits].alias("edits"), trees[tree].alias("tree"))
    counts_type = T._parse_datatype_string(COUNTS_TYPE)
    fields = [*rest.schema.fields, *([trees.schema[tree]] if grown else []), T.StructField(counted, counts_type)]
    names = [f.name for f in fields]

    def after(b: pa.RecordBatch, enc: Counter) -> list[CountTree | None]:
        column = b.column(b.num_columns - 1)
        chars, tokens, leaves = (column.field(name) for name in ("chars", "tokens", "leaves"))
        stored, ends = tuple(leaves.values.field(k) for k in range(3)), leaves.offsets.to_pylist()
        out = []
        for k, es in enumerate(b.column(b.num_columns - 2).to_pylist()):
            if not column[k].is_valid:
                out.append(None)
                continue
            t = CountTree.kept(enc, chars[k].as_py(), tokens[k].as_py(), list(range(ends[k], ends[k + 1])), stored)
            t.before = t.n_tokens
            for e in es or []:
                if e is not None:
                    t.edit(e["start"] or 0, e["length"] or 0, e["new"] or "")
            out.append(t)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = counter(shared)
        for b in _slices(batches):
            done = after(b, enc)
            kind = pa.struct([(f.name, pa.int64()) for f in counts_type.fields])
            values = [t and (t.before, t.n_tokens, t.n_chars, t.reencoded) for t in done]
            counts = pa.array([v and dict(zip(kind.names, v, strict=True)) for v in values], kind)
            new = []
            if grown:
                whole = _table([t for t in done if t])
                place = iter(range(len(whole)))
                new = [whole.take(pa.array([next(place) if t else None for t in done], pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *new, counts], names)

    return rows.mapInArrow(run, T.StructType(fields))


def count_after_edits(spark: SparkSession, trees: DataFrame, tokenizer_path: str, edits: str = "edits", tree: str = "tree", key: str = "doc_id") -> DataFrame:
    """Per kept tree: the key, n_tokens_before, n_tokens_after, n_chars_after, n_reencoded, as edit() gives them."""
    rows = trees.select(F.col(key), F.col(edits).alias("edits"), F.col(tree).alias("tree"))
    return edit(spark, rows, tokenizer_path, grown=False).select(key, "counted.*")


def sample_edits(docs: DataFrame, n_chars: Column) -> DataFrame:
    """docs with three edits each, which follow from doc_id and the text's length: an insertion, a deletion, a replacement."""
    at = lambda k: F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(k)), n_chars + 1).cast("int")
    change = lambda k, length, new: F.struct(at(k).alias("start"), F.lit(length).alias("length"), F.lit(new).alias("new"))
    return docs.withColumn("edits", F.array(change(1, 0, "it's  new\n"), change(2, 17, ""), change(3, 5, " 42nd <|endoftext|>")))
