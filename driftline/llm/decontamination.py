"""Operator 3: benchmark decontamination with Spark expressions only.

Item-sized windows of a document get SimHash fingerprints; multi-index Hamming blocks find every item whose
fingerprint lies within the radius; an exact weighted Jaccard of five-word shingles verifies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from driftline.llm.common import ascii_lower, constant, let, row_of, unused, words

K, SIMILARITY = 5, 0.8
#: Greatest Hamming distance of fingerprints. Similarity 0.8 means a cosine of 0.89 at least, 10 bits expected, deviation below 3:
#: votes are of distinct (shingle, occurrence) pairs, so this holds for repetitive windows too.
RADIUS = 24
#: radius + 1 blocks of bits: two fingerprints within the radius agree in one block at least. (first bit, bits)
BLOCKS = tuple((64 * k // (RADIUS + 1), 64 * (k + 1) // (RADIUS + 1) - 64 * k // (RADIUS + 1)) for k in range(RADIUS + 1))
#: Bits of the shingle bitmap for each benchmark shingle, and its greatest size (8 MB, whatever the benchmark's).
BITS_EACH, MOST_BITS = 512, 1 << 26


def word_hashes(text: Column) -> Column:
    """Hashes of the words in order, A-Z lower-cased."""
    return F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))


def roll(hashes: Column) -> Column:
    """Hashes of the five-word shingles in order; a text of fewer words, but one at least, is one shingle."""
    n = F.size(hashes)
    many = F.transform(F.slice(hashes, 1, F.greatest(n - K + 1, F.lit(0))), lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, K))))
    return F.when(n >= K, many).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.expr("cast(array() as array<bigint>)"))


def simhash(hashes: Column, lane: int = 16) -> Column:
    """64-bit SimHash of a multiset of hashes: the k-th occurrence of a hash has a vote of its own.

    So the votes are those of a set whose plain Jaccard is the weighted one of the multiset. They are kept in `lane`
    numbers with lanes of as many bits (16 or 32), which hold fewer than 2 ** lane hashes.
    """
    lanes, none = sum(1 << at for at in range(0, 64, lane)), F.lit(None).cast("long")
    vote = lambda a, h: [(a[f"v{b}"] + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(lanes))).alias(f"v{b}") for b in range(lane)]
    # Sorted, equal hashes are neighbours. A step adds the vote of the one before, so that each is hashed once.
    again = lambda a, h: F.when(h.eqNullSafe(a["last"]), a["k"] + 1).otherwise(F.lit(0).cast("long"))
    last = lambda a, h: F.when(h.eqNullSafe(a["last"]), F.xxhash64(h, a["k"] + 1)).otherwise(h)
    votes = F.aggregate(
        F.sort_array(hashes),
        F.struct(*(F.lit(0).cast("long").alias(f"v{b}") for b in range(lane)), none.alias("last"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x")),
        lambda a, h: F.struct(*vote(a, a["x"]), h.alias("last"), again(a, h).alias("k"), last(a, h).alias("x")),
        lambda a: F.struct(*vote(a, a["x"])),
    )
    n, full = F.size(hashes), (1 << lane) - 1
    bit = lambda v, b, j: F.when(F.shiftrightunsigned(v[f"v{b}"], lane * j).bitwiseAND(F.lit(full)) * 2 > n, F.shiftleft(F.lit(1).cast("long"), b + lane * j)).otherwise(F.lit(0).cast("long"))
    return F.get(F.transform(F.array(votes), lambda v: reduce(lambda x, y: x.bitwiseOR(y), (bit(v, b, j) for b in range(lane) for j in range(64 // lane)))), F.lit(0))


def block_keys(fingerprint: Column) -> Column:
    """array<struct<block, value>>: the multi-index keys of a fingerprint."""
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit((1 << n) - 1)).cast("int").alias("value")) for k, (at, n) in enumerate(BLOCKS)))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two multisets given as arrays: sum of minima over sum of maxima of the counts."""
    count = lambda xs, h: F.size(F.filter(xs, lambda x: x == h))
    single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, h: s + F.least(count(a, h), count(b, h)))
    common = F.when(single, F.size(F.array_intersect(a, b))).otherwise(counted)
    return common / (F.size(a) + F.size(b) - common)


def bitmap(items: DataFrame) -> tuple[Column, int]:
    """(a constant array of longs with a bit set for each shingle of the items, bits). Bounded by MOST_BITS."""
    one = items.select(F.explode("shingles").alias("h")).distinct()
    bits = min(MOST_BITS, 1 << max(16, (one.count() * BITS_EACH).bit_length()))
    place = F.pmod(F.col("h"), F.lit(bits))
    rows = one.groupBy((place / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))).alias("set")).collect()
    table = [0] * (bits // 64)
    for r in rows:
        table[r["word"]] = r["set"]
    return constant(table, "bigint"), bits


def find(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Leaks: key, item_id, start (word of the best window, from 0), n_words (of the item), similarity; one row a pair.

    A window starts at a shingle that an item has too and is as long as the item, or reaches the document's end.
    No better window is missed: moved to the right until it starts at a common shingle, a window loses nothing.
    Candidate starts come from a bitmap of the items' shingles, which only ever lets too many through. Null and
    empty texts and items match nothing; an item of fewer than five words is one hash of all its words, found only in
    a document of exactly these words, never inside a longer one; an item longer than a document matches what there
    is of it, and a row of a document holds a window of the longest item's length for each candidate start, so very
    long items cost memory in proportion; repeated rows of one key give one row a pair; of windows as good the
    first one stands; all benchmark items are used, with whole texts. Documents are read in one narrow pass: what is shuffled grows
    with the leaks, not with the corpus.
    """
    items = let(benchmark.where(F.col("text").isNotNull()), "hashes", word_hashes(F.col("text")))
    items = let(items, "item_shingles", roll(F.col("hashes"))).select("item_id", "item_shingles", F.size("hashes").alias("n_words"), F.size("item_shingles").alias("n"))
    items = items.where(F.col("n") > 0)
    longest = items.agg(F.max("n")).first()[0]
    if longest is None:
        return docs.where(F.lit(False)).select(key, F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"))
    lane = 16 if longest < 1 << 16 else 32
    items = let(items, "item_print", simhash(F.col("item_shingles"), lane))
    table, bits = bitmap(items.select(F.col("item_shingles").alias("shingles")))
    is_set = lambda h: F.getbit(F.get(table, F.floor(F.pmod(h, F.lit(bits)) / 64).cast("int")), F.pmod(h, F.lit(64)).cast("int")) == 1
    hashed = let(let(docs.select(key, text), "_w", word_hashes(F.col(text))).select(key, "_w"), "_s", roll(F.col("_w"))).select(key, "_s")
    at = F.filter(F.transform("_s", lambda h, i: F.when(is_set(h), i)), lambda i: i.isNotNull())
    starts = F.transform(at, lambda i: F.struct(i.cast("int").alias("start"), F.slice("_s", i + 1, longest).alias("ahead")))
    ahead = hashed.select(key, F.explode(starts).alias("w")).select(key, "w.*").withColumn("first", F.get("ahead", F.lit(0)))
    sizes = items.select(F.explode(F.array_distinct("item_shingles")).alias("first"), "n").distinct()
    windows = ahead.join(sizes, "first").select(key, "start", "n", F.slice("ahead", F.lit(1), F.col("n")).alias("window"))
    prints = let(windows, "print", simhash(F.col("window"), lane))
    indexed = items.select("item_id", "n", "n_words", "item_print", "item_shingles", F.explode(block_keys(F.col("item_print"))).alias("b")).select("*", "b.*").drop("b")
    close = prints.withColumn("b", F.explode(block_keys(F.col("print")))).select("*", "b.*").drop("b").join(indexed, ["n", "block", "value"])
    # A pair that agrees in several blocks is taken in the first of them.
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    earlier = reduce(lambda x, y: x | y, ((F.col("block") > k) & (F.shiftrightunsigned(differ, a).bitwiseAND(F.lit((1 << m) - 1)) == 0) for k, (a, m) in enumerate(BLOCKS)))
    near = close.where((F.bit_count(differ) <= RADIUS) & ~earlier)
    verified = let(near, "similarity", similarity(F.col("window"), F.col("item_shingles"))).where(F.col("similarity") >= least)
    best = verified.groupBy(key, "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best"))
    return best.select(key, "item_id", (-F.col("best.back")).alias("start"), F.col("best.n_words").alias("n_words"), F.col("best.similarity").alias("similarity"))


def remove(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """docs without those that leak an item; each is judged by its own text, whether its doc_id is null or repeated. All columns stay."""
    keyed = docs.select(row_of("doc_id", "text").alias("row"), "text")
    leaks = find(keyed, benchmark, least, key="row").select(F.col("row").alias("leak")).distinct()
    leak = unused(docs, "leak")
    return docs.join(leaks.withColumnRenamed("leak", leak), row_of("doc_id", "text") == F.col(leak), "left_anti")
