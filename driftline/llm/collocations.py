"""Operator 12: phrases of up to four words that stand together, by names of pairs.

A word has a name (64 bits of a hash of language and word, checked to be its own in the whole corpus). A phrase of k
words is the pair of its first and its last k - 1 words, and its name is made of their names: replacing neighbouring
frequent names by the name of their pair, level after level, names every phrase whose parts are all frequent. The
table of a level is joined with the one below through both names, which gives the frequencies of all parts for the
cuts, and the two pointers say which shorter phrases a phrase contains.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from driftline.llm.common import cut, spent

#: Words of a phrase at most, least frequency, share of a longer phrase (in %) that makes a shorter one superfluous.
LONGEST, LEAST, SHARE, TOP = 4, 30, 80, 2000
#: What ends a piece, and what parts words within one.
BREAKS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: Bits of the filter of frequent names: its size whatever the corpus; a fuller one only lets more candidates through.
FILTER_BITS = 1 << 27
#: Names of one part of the counts, about, names that a task gathers before it sends them, and names that it sends at once.
PART, GATHERED, SENT = 1 << 21, 1 << 21, 1 << 18
#: Bits of a name by which pairs are counted at first; more than those of the filter.
SHORT = 48
#: The first of the bits of a name that give its second place in the filter; with those of FILTER_BITS no more than SHORT.
SECOND = 20
#: Bytes of text of one language whose phrases are counted together before they leave a task; of all languages, a task holds OPEN times as many.
BLOCK, OPEN = 1 << 22, 4
#: Bytes of blocks that Spark writes, and so reads, at once; left to itself it gathers 100 blocks before it looks.
WRITTEN = 1 << 22

#: Rows that are taken out of an Arrow batch at once.
SLICE = 256

_TEXTS = pa.list_(pa.string())
_PLAIN = bytes.maketrans(BREAKS + GAPS, b"\n" * len(BREAKS) + b" " * len(GAPS))


class _Places(dict):
    """The distinct words of a block; a new one takes the next place."""

    def __init__(self) -> None:
        super().__init__({b"\n": -1, b"": -2})

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self) - 2
        return place


class Block:
    """The words of some texts of one language as places in the list of distinct ones; -1 where a piece or a text ends."""

    def __init__(self) -> None:
        self.known, self.places, self.size = _Places(), array("i"), 0

    def add(self, text: str) -> int:
        """The bytes that the block has more now."""
        plain = text.encode().lower().translate(_PLAIN)  # lower() of bytes is A-Z only
        self.places.extend(map(self.known.__getitem__, plain.replace(b"\n", b" \n ").split(b" ")))
        self.places.append(-1)
        self.size += len(plain) + 1
        return len(plain) + 1

    def row(self, lang: str, salt: int) -> pa.RecordBatch:
        words, index = list(self.known)[2:], np.frombuffer(self.places, np.int32)
        index = index[index > -2]
        counts = np.bincount(index[index >= 0], minlength=len(words))
        names = word_names([lang], words, salt).tobytes()
        cells = [pa.array([lang]), pa.ListArray.from_arrays([0, len(words)], pa.array(words, pa.binary()).cast(pa.string())), pa.array([counts], pa.list_(pa.int64())), pa.array([names], pa.binary()), pa.array([_packed(index, len(words))], pa.binary())]
        return pa.RecordBatch.from_arrays(cells, ["lang", "words", "counts", "names", "index"])


def _kind(n: int) -> type:
    """The numbers that n places and -1 need, one up."""
    return np.uint16 if n < 1 << 16 else np.uint32


def _packed(index: np.ndarray, n: int) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress((index + 1).astype(_kind(n)))


def _index(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), _kind(n)).astype(np.int32) - 1


def blocks(docs: DataFrame, salt: int = 0, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, words, counts and names (of the distinct words of a block of texts of one language) and index, the texts as places in them, packed."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Block] = {}
        held = 0
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    block = opened.get(name) or opened.setdefault(name, Block())
                    held += block.add(t)
                    if block.size >= BLOCK or held >= OPEN * BLOCK:
                        largest = max(opened, key=lambda x: opened[x].size)
                        block = opened.pop(largest)
                        held -= block.size
                        yield block.row(largest, salt)
        while opened:
            name, block = opened.popitem()
            yield block.row(name, salt)

    return rows.mapInArrow(run, "lang string, words array<string>, counts array<long>, names binary, index binary")


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The names of pairs of names."""

    def rounds(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))

    a = rounds(left + np.uint64(0x9E3779B97F4A7C15))
    b = rounds(right ^ np.uint64(0xC2B2AE3D27D4EB4F))
    return rounds(b ^ (a * np.uint64(0x165667B19E3779F9)))


def word_names(langs: list[str], words: list[bytes], salt: int) -> np.ndarray:
    """The names of words; one language for all of them, or one each."""
    before = {lang: f"{len(lang)} {lang}".encode() for lang in set(langs)}
    named = [xxhash.xxh3_64_digest(before[lang] + w, salt) for lang, w in zip(langs * len(words) if len(langs) == 1 else langs, words, strict=True)]
    return np.frombuffer(b"".join(named), np.uint64)


class Filter:
    """A bitmap of frequent names, two bits each; what it holds not both of is surely not frequent."""

    def __init__(self, rows: DataFrame, bits: int = FILTER_BITS) -> None:
        self.bits = min(bits, 1 << max(12, (rows.count() * 16).bit_length()))
        rows = rows.select(F.explode(F.array("lo", F.shiftright("lo", SECOND))).alias("lo"))
        place = F.pmod(F.col("lo"), F.lit(self.bits))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
        found = rows.groupBy(F.floor(place / 64).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
        self.table = np.zeros(self.bits // 64, np.uint64)
        self.table[found["at"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)

    def holds(self, lo: np.ndarray) -> np.ndarray:
        def bit(of: np.ndarray) -> np.ndarray:
            place = of & np.uint64(self.bits - 1)
            return (self.table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1

        return bit(lo) & bit(lo >> np.uint64(SECOND))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted keys and their counts."""
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begins], np.diff(np.append(begins, len(keys)))


class _Level:
    """Names of the phrases of one length in a block, and where they stand."""

    def __init__(self, names: np.ndarray, index: np.ndarray) -> None:
        self.names, self.index = names, index

    def without(self, frequent: Filter) -> _Level:
        """Without the names that surely are not frequent."""
        good = np.append(frequent.holds(self.names), False)  # a place of -1 is the last one
        return _Level(self.names, np.where(good[self.index], self.index, -1))

    def _keys(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero((self.index[:-1] >= 0) & (self.index[1:] >= 0))
        return at, self.index[at].astype(np.int64) * max(len(self.names), 1) + self.index[at + 1]

    def _halves(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.divmod(keys, max(len(self.names), 1))
        return self.names[left], self.names[right]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two names of each distinct pair of neighbours, and its count."""
        keys, n = _counted(np.sort(self._keys()[1]))
        return *self._halves(keys), n

    def above(self) -> _Level:
        """Each two neighbours replaced by the name of their pair."""
        at, keys = self._keys()
        order = np.argsort(keys)
        found, n = _counted(keys[order])
        index = np.full(len(self.index), -1, np.int32)
        index[at[order]] = np.repeat(np.arange(len(found)), n)
        return _Level(_mixed(*self._halves(found)), index)


def _levels(found: DataFrame, filters: list, emit, schema: str) -> DataFrame:
    """What `emit` makes of the blocks of a task, named up to the level of the last filter; names that a filter lacks end a run.

    A block holds the names of its words, so naming again is a sort of numbers for each level.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[_Level]:
        for b in batches:
            for k in range(b.num_rows):
                names = np.frombuffer(b.column(0)[k].as_py(), np.uint64)
                level = _Level(names, _index(b.column(1)[k].as_py(), len(names))).without(filters[0].value)
                for frequent in filters[1:]:
                    level = level.above().without(frequent.value)
                yield level

    return found.select("names", "index").mapInArrow(lambda batches: emit(each(batches)), schema)


def _merged(*columns: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of all columns but the last in order, with the sums of the last, their counts."""
    *keys, counts = columns
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    begins = np.flatnonzero(np.logical_or.reduce([np.append(True, k[1:] != k[:-1])[: len(k)] for k in keys]))
    return [*(k[begins] for k in keys), np.add.reduceat(counts[order], begins) if len(begins) else counts]


def _planes(numbers: np.ndarray) -> bytes:
    """Packed with the first bytes of all numbers first, then the second ones: the last are mostly zero."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T))


def _numbers(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def _part(lo: np.ndarray, parts: int) -> np.ndarray:
    """The part of each name: by the first of its last SHORT bits."""
    return (((lo & np.uint64((1 << SHORT) - 1)) >> np.uint64(SHORT - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _sent(part: np.ndarray, names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row for each part, in which its numbers are packed: the first column, which is in order, as differences."""
    for at in range(0, len(part), SENT):  # a part may go in two rows
        of = part[at : at + SENT]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        edges = [*(at + first).tolist(), at + len(of)]
        cells = [pa.array([_planes(np.diff(c[a:b], prepend=c.dtype.type(0)) if c is columns[0] else c[a:b]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(of[first]), *cells], ["part", *names])


def _received(rows: pa.Table, names: list[str]) -> list[np.ndarray]:
    """The columns of _sent() of all rows; those of names are unsigned, counts, the last, signed."""
    columns = [[_numbers(v, np.int64 if c == names[-1] else np.uint64) for v in rows[c].to_pylist()] for c in names]
    return [np.concatenate([np.cumsum(v) for v in columns[0]]), *map(np.concatenate, columns[1:])]


def _sketch(found: DataFrame, filters: list, least: int, parts: int) -> DataFrame:
    """The last SHORT bits of lo of the pairs of names that occur `least` times or share these bits with others so that together they do.

    Names are sent in packed parts, by their first bits, so that a part is some PART of them whatever the corpus, in
    order, as differences; a pair that every block holds comes once from each gathering of a task.
    """
    columns = ["names", "counts"]

    def emit(levels: Iterator[_Level]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            lo, counts = _merged(*map(np.concatenate, zip(*gathered, strict=True)))
            yield from _sent(_part(lo, parts), columns, [lo, counts])

        for level in levels:
            left, right, k = level.pairs()
            gathered.append((_mixed(left, right) & np.uint64((1 << SHORT) - 1), k))
            n += len(k)
            if n > GATHERED:
                yield from packed()
                gathered, n = [], 0
        if n:
            yield from packed()

    def merge(rows: pa.Table) -> pa.Table:
        lo, n = _merged(*_received(rows, columns))
        return pa.table({"lo": lo[n >= least].view(np.int64)})

    sent = _levels(found, filters, emit, "part long, names binary, counts binary")
    return sent.groupBy("part").applyInArrow(merge, "lo long")


class Clash(Exception):
    """Two words or phrases share a name; another salt gives other names."""


def _unique(named: DataFrame) -> None:
    if not named.groupBy("lo").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        raise Clash


def _shared(rows: DataFrame):
    return rows.sparkSession.sparkContext.broadcast(Filter(rows))


def _words(found: DataFrame, salt: int) -> DataFrame:
    """lang, phrase, a and lo, the name, of each word of the corpus."""

    @F.pandas_udf("long")
    def name(langs: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series(word_names(list(langs), [w.encode() for w in words], salt).view(np.int64))

    each = found.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.*")
    counted = each.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("a"))
    return counted.withColumn("lo", name("lang", "phrase"))


def _pairs(found: DataFrame, filters: list, least: int, parts: int) -> DataFrame:
    """left_lo, right_lo, a, lo: the frequent pairs of names of the level below, their counts and names.

    First counts of SHORT bits of each name, which are never too small, say which pairs may be frequent; those alone are
    counted by both halves, gathered and sent like the sketch, so that Spark has one row for each pair of the corpus and
    not one for each block that holds it. All pairs that share a name meet in a part, whether frequent or not.
    """
    may = cut(_sketch(found, filters, least, parts))
    frequent = _shared(may)
    columns = ["left", "right", "counts"]

    def emit(levels: Iterator[_Level]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            part, *halves, counts = _merged(*map(np.concatenate, zip(*gathered, strict=True)))
            yield from _sent(part, columns, [*halves, counts])

        for level in levels:
            left, right, k = level.pairs()
            lo = _mixed(left, right)
            good = frequent.value.holds(lo)
            gathered.append((_part(lo[good], parts), left[good], right[good], k[good]))
            n += len(gathered[-1][0])
            if n > GATHERED // 2:  # a pair takes twice the room of a name of the sketch
                yield from packed()
                gathered, n = [], 0
        if n:
            yield from packed()

    def merge(rows: pa.Table) -> pa.Table:
        left, right, n = _merged(*_received(rows, columns))
        lo = _mixed(left, right)
        names, k = np.unique(lo, return_counts=True)
        good = (n >= least) | np.isin(lo, names[k > 1])  # those that share a name are for _unique()
        return pa.table({"left_lo": left[good].view(np.int64), "right_lo": right[good].view(np.int64), "a": n[good], "lo": lo[good].view(np.int64)})

    sent = _levels(found, filters, emit, "part long, left binary, right binary, counts binary")
    named = cut(sent.groupBy("part").applyInArrow(merge, "left_lo long, right_lo long, a long, lo long"))
    spent(may)
    frequent.unpersist()
    _unique(named)
    return named.where(F.col("a") >= least)


def _table(pairs: DataFrame, below: DataFrame) -> DataFrame:
    """The table of a level: its pairs with language, phrase, last word and the counts of their first and last 1, 2, ... words."""
    left = below.select(F.col("lo").alias("left_lo"), "lang", F.col("phrase").alias("before"), "heads")
    right = below.select(F.col("lo").alias("right_lo"), "last", "tails")
    both = pairs.join(left, "left_lo").join(right, "right_lo")
    longer = lambda c: F.concat(F.col(c), F.array("a")).alias(c)
    return both.select("lo", "left_lo", "right_lo", "lang", F.concat_ws(" ", "before", "last").alias("phrase"), "last", "a", longer("heads"), longer("tails"))


#: The lowest cut of a phrase: exact whole numbers (decimals of 38 digits), ties to the shortest first part.
_CUT = """array_min(transform(sequence(1, size(heads) - 1), j -> struct(
  (2000000BD * cast(a AS decimal(19, 0))) div (cast(heads[j - 1] AS decimal(19, 0)) + cast(tails[size(heads) - j - 1] AS decimal(19, 0))) AS score,
  j AS first, heads[j - 1] AS l, tails[size(heads) - j - 1] AS r)))"""


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, l, r, score of all phrases that are not superfluous; lang, n: the words of each language).

    Words, pieces, cuts and scores as the constants above say; l, r are the counts of the two parts of the lowest cut.
    A phrase is superfluous if a longer one that holds it has `share` % of its count; as counts only fall from a phrase
    to a longer one, the pairs that point to it tell. Null texts count as empty, a null language is `und`; repeated
    rows count each; texts without words and empty tables give nothing. Other columns are ignored.
    """
    for salt in range(8):
        found = cut(blocks(docs, salt, text, lang), WRITTEN)
        try:
            return _phrases(found, salt, longest, least, share)
        except Clash:
            spent(found)
    raise Clash("eight salts in a row")


def _phrases(found: DataFrame, salt: int, longest: int, least: int, share: int) -> tuple[DataFrame, DataFrame]:
    words = cut(_words(found, salt))
    _unique(words)
    parts = 1 + (words.agg(F.sum("a")).first()[0] or 0) // PART
    first = words.where(F.col("a") >= least)
    filters = [_shared(first.select("lo"))]
    tables = [first.select("lo", "lang", "phrase", F.col("phrase").alias("last"), "a", F.array("a").alias("heads"), F.array("a").alias("tails"))]
    for _ in range(2, longest + 1):
        tables.append(cut(_table(_pairs(found, filters, least, parts), tables[-1])))
        filters.append(_shared(tables[-1].select("lo")))
    out = []
    for k, level in enumerate(tables[1:], 1):
        scored = level.select("lo", "lang", "phrase", "a", F.expr(_CUT).alias("cut"))
        if k + 1 < len(tables):
            inner = lambda side: tables[k + 1].select(F.col(f"{side}_lo").alias("lo"), F.col("a").alias("longer"))  # noqa: B023, E731
            above = inner("left").unionAll(inner("right")).groupBy("lo").agg(F.max("longer").alias("longer"))
            scored = scored.join(above, "lo", "left").where(F.expr(f"longer IS NULL OR 100 * longer < {share} * a"))
        out.append(scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = out[0]
    for more in out[1:]:
        every = every.unionAll(more)
    return every, words.groupBy("lang").agg(F.sum("a").alias("n"))


def best(docs: DataFrame, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score; see phrases()."""
    found, sizes = phrases(docs, text, lang)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")  # Spark keeps `top` of each task before it shuffles
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
