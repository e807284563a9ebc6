"""Operator 6: n-gram Jaccard join with components.

The shingles of a document are hashed into groups; its group counts are a point. No overlap of two sets exceeds the
sum over the groups of the smaller count, so an R-tree over points tells which pairs can't link: what holds for two
boxes (with the greatest counts in each) holds for all points in them.

One tree over all points would not prune: in so many dimensions all boxes meet near its root. So points are dealt to
hubs first. A document and another one that links with it share one of their first shingles in an order common to all
(see prefix_sizes()); the hub of a shingle is the least set that has it there, and each set goes to the hubs of its
first shingles. Then, by Spark joins:

1. Each hub is compared with its sets; what links gives first components.
2. In a hub whose sets are not all in one component yet, an R-tree is packed (sets sorted by size and counts, FANOUT
   to a box, boxes again, until few are left) and joined with itself from the top down, by the bound.
3. In two boxes that pass, the points that pass are compared exactly, by the sets of their texts; no pair is a row.

The components are exact. Links are not listed: a pair already known to be in one component is not compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from driftline.llm.common import cut, identity, packed_texts, portions, row_of, spent, unpacked, unused
from driftline.llm.hashing import FOLD, mix, run_hashes, word_hashes

SHINGLE, LEAST = 4, 85
#: Shingles a group, or up to twice as many, and the fewest and most groups of a point. Points of more groups fold to fewer by sums of neighbours.
EACH_GROUP, FEWEST, MOST = 1, 32, 16384
#: A count that stands for so many or more, and what it is taken for: more than any set holds, so that it bounds nothing.
FULL, MANY = 255, 1 << 40
#: A point whose counts are all less takes half a byte for each.
HALF = 16
#: Groups of a point for each group of a box of points: the greatest counts of many points say little in fine groups.
COARSER = 4
#: Entries of a box of the R-tree.
FANOUT = 64
#: Pairs for each point of two boxes up to which the pairs themselves go on.
SPARSE = 2
#: A shingle of more than this share of the documents is put last in the order of shingles. At most (mean set
#: size) / HOT_SHARE shingles can be so common, however large the corpus: a few MB to broadcast.
HOT_SHARE = 1 / 2000
#: Shingles counted at once by a task, and the least count of them that it reports.
COUNTED, REPORTED = 1 << 21, 3
#: Texts of each side that are compared at once.
BLOCK = 64
#: Prefix shingles keep so many bits of their hash; one too many that meets only costs a comparison.
_SHORT = np.uint64((1 << 48) - 1)
_U = np.uint64


def shingle_sets(texts: Iterable[bytes], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, A-Z lower-cased; of a shorter text its words as one."""
    for h in word_hashes(t.translate(FOLD) for t in texts):
        yield np.unique(run_hashes(h, min(k, len(h)))) if len(h) else h


def encoded(texts: Iterable[str | None]) -> Iterator[bytes]:
    return ((t or "").encode() for t in texts)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts as bytes: 0 and half a byte for each, if all are less than HALF, else 1 and a byte for each."""
    if counts.max() < HALF:
        return b"\0" + (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    return b"\1" + np.minimum(counts, FULL).astype(np.uint8).tobytes()


def group_counts(shingles: np.ndarray) -> bytes:
    """The point of a set: how many of its shingles fall into each group, by the first bits of a hash."""
    bits = min(MOST, max(FEWEST, len(shingles) // EACH_GROUP)).bit_length() - 1
    return packed_counts(np.bincount((mix(shingles * _U(3) + _U(11)) >> _U(64 - bits)).astype(np.int64), minlength=1 << bits))


def groups_of(point: bytes) -> int:
    """How many groups a point or box has."""
    return len(point) - 1 if point[0] else 2 * (len(point) - 1)


def folded(point: bytes, groups: int) -> np.ndarray:
    """The counts of a point in as many groups or fewer, by sums of neighbours; FULL counts are MANY."""
    raw = np.frombuffer(point, np.uint8, offset=1)
    if point[0]:
        counts = np.where(raw == FULL, MANY, raw.astype(np.int64))
    else:
        counts = np.stack((raw & 15, raw >> 4), 1).astype(np.int64)
    return counts.reshape(groups, -1).sum(1)


def most_common(a: bytes, b: bytes) -> int:
    """A bound on the overlap of two sets, or of any two of two boxes: the sum of the minima of their counts."""
    groups = min(groups_of(a), groups_of(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum())


def needed(total, least: int = LEAST):
    """The overlap that sets of this total size must have: 100 * both >= least * (total - both)."""
    return -(-least * total // (100 + least))


def prefix_sizes(n: int, least: int = LEAST) -> tuple[int, int]:
    """(short, long): in any order common to all, a set shares one of its first `short` shingles with the first `long`
    of each set linked to it that is no smaller.

    Of n shingles the overlap with such a set is at least needed(2 * n), with a smaller one at least `least` per cent of n.
    """
    return n - needed(2 * n, least) + 1, n - -(-least * n // 100) + 1


def ordered(shingles: np.ndarray) -> np.ndarray:
    """The shingles in the order of a hash."""
    return np.sort((mix(shingles + _U(7)) & _SHORT).view(np.int64))


def profiles(docs: DataFrame, hot: np.ndarray, text: str, key: str, least: int, bits: int = 64) -> DataFrame:
    """row, late, id (see identity()), n (shingles), sid and check (hashes of the set, null for an empty one), point, short, usual, prefix.

    The prefix is the first shingles of the set by their hashes, hot ones last; equal sets have equal ones. `short` of
    them are its short prefix, `usual` are not hot. sid has `bits` bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(hot))

    def one(s: np.ndarray, common: np.ndarray) -> tuple:
        if not len(s):
            return 0, None, None, group_counts(s), 0, 0, s.view(np.int64)
        order, usual = ordered(s), len(s)
        if len(common):
            late = common[np.minimum(np.searchsorted(common, order), len(common) - 1)] == order
            order, usual = np.concatenate((order[~late], order[late])), int(len(s) - late.sum())
        x, y = (mix(mix(s * _U(2 * i + 1) + _U(i)).sum(dtype=np.uint64, keepdims=True) + _U(len(s)))[0] for i in (1, 2))
        short, long = prefix_sizes(len(s), least)
        return len(s), int((x >> _U(64 - bits)).astype(np.int64)), int(y.astype(np.int64)), group_counts(s), short, min(usual, long), order[:long]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "text"):
                rows = [one(s, shared.value) for s in shingle_sets(encoded(part["text"]))]
                out = pd.DataFrame(rows, columns=["n", "sid", "check", "point", "short", "usual", "prefix"]).astype({"sid": "Int64", "check": "Int64"})
                # Built of whole numbers and nulls at once, pandas would make floats of the hashes.
                for at, c in ((1, "sid"), (2, "check")):
                    out[c] = pd.array([r[at] for r in rows], dtype="Int64")
                yield out.assign(**{c: part[c].array for c in ("row", "late", "id")})[["row", "late", "id", *out.columns]]

    rows = docs.select(*identity(key, text), F.col(text).alias("text"))
    return rows.mapInPandas(run, "row long, late boolean, id long, n long, sid long, check long, point binary, short int, usual int, prefix array<long>")


def hot_tokens(docs: DataFrame, n_docs: int, text: str) -> np.ndarray:
    """Shingles of too many documents, by lossy counting over all texts; only the speed depends on which are found.

    Each task counts its shingles and reports those it met a few times; a shingle as common as that in the whole
    corpus is met so often in most tasks.
    """

    def counts(tokens: list[np.ndarray]) -> pd.DataFrame:
        u, n = np.unique(np.concatenate(tokens), return_counts=True)
        return pd.DataFrame({"token": u[n >= REPORTED], "n": n[n >= REPORTED]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, total = [], 0
        for b in batches:
            for part in portions(b, "text"):
                for s in shingle_sets(encoded(part["text"])):
                    tokens.append(ordered(s))
                    total += len(s)
                    if total >= COUNTED:
                        yield counts(tokens)
                        tokens, total = [], 0
        if tokens:
            yield counts(tokens)

    rows = docs.select(F.col(text).alias("text")).mapInPandas(run, "token long, n long")
    most = max(64, int(n_docs * HOT_SHARE))
    return rows.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > most).select("token").toPandas()["token"].to_numpy()


def told_apart(each: DataFrame) -> DataFrame:
    """each, with another sid where sets that differ (by 128 bits) share one."""
    wrong = each.where("sid is not null").groupBy("sid").agg(F.min("check").alias("c0"), F.max("check").alias("c1")).where("c0 != c1").select("sid")
    wrong = cut(wrong)
    if wrong.isEmpty():
        spent(wrong)
        return each
    marked = each.join(wrong.withColumn("wrong", F.lit(True)), "sid", "left")
    return cut(marked.withColumn("sid", F.when(F.col("wrong"), F.xxhash64("sid", "check")).otherwise(F.col("sid"))).drop("wrong"))


def leaves(each: DataFrame) -> DataFrame:
    """hub, sid: the sets of each hub but itself. Both are sids.

    Usual shingles, each in a bounded share of the sets, are dealt once; hot ones are few, so that their hubs are found by
    partial aggregation and a small join.
    """

    def tokens(first: str, count: str) -> DataFrame:
        part = each.where("sid is not null").select("sid", "short", F.expr(first).alias("skip"), F.posexplode(F.expr(f"slice(prefix, {first} + 1, {count})")).alias("place", "token"))
        return part.select("token", "sid", (F.col("place") + F.col("skip") < F.col("short")).alias("first"))

    hub = F.min(F.when(F.col("first"), F.col("sid")))
    same = Window.partitionBy("token")
    usual = tokens("0", "usual").withColumn("hub", hub.over(same))
    hot = tokens("usual", "size(prefix) - usual")
    hot = hot.join(hot.groupBy("token").agg(hub.alias("hub")), "token")
    both = usual.select("hub", "sid").unionByName(hot.select("hub", "sid"))
    return both.where("hub is not null and hub != sid").distinct()


def fits(n: str, m: str, least: int):
    """Whether sets of n shingles at least and m at most, or the other way round, can link by their sizes."""
    return F.lit(100) * F.col(n) >= F.lit(least) * F.col(m)


def with_peers(few: DataFrame, least: int) -> DataFrame:
    """The sets (hub, sid, n) of hubs of FANOUT sets at most that may link with another one of their hub by their sizes: one of the next in size."""
    size = Window.partitionBy("hub").orderBy("n", "sid")
    both = few.withColumn("less", F.lag("n").over(size)).withColumn("more", F.lead("n").over(size))
    return both.where(F.coalesce(fits("less", "n", least), F.lit(False)) | F.coalesce(fits("n", "more", least), F.lit(False))).drop("less", "more")


def bounded(pairs: DataFrame, columns: list[str], least: int) -> DataFrame:
    """The rows of pairs whose points or boxes (lo_x, top_x, lo_y, top_y) may hold linked sets, by the bound."""
    kind = ", ".join(f"{c} long" for c in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in portions(b, "top_x"):
                keep = [most_common(x, y) >= needed(n + m, least) for x, y, n, m in zip(part["top_x"], part["top_y"], part["lo_x"], part["lo_y"], strict=True)]
                yield part.loc[np.array(keep, bool), columns]

    return pairs.select(*columns, "lo_x", "top_x", "lo_y", "top_y").mapInPandas(run, kind)


def boxed(entries: DataFrame, coarser: int = 1) -> DataFrame:
    """Entries (hub, item, lo, hi, top, c0, c1) with `parent`, the box of FANOUT of them that each is in, and the boxes as
    entries of their own (parent null).

    Entries are sorted by size and counts over all tasks, so that a hub of any size is dealt evenly. A box has a group for
    `coarser` ones of its entry of fewest groups.
    """
    columns = ["hub", "parent", "item", "lo", "hi", "top", "c0", "c1"]

    def box(rows: list[tuple]) -> tuple:
        groups = max(2, min(groups_of(r[5]) for r in rows) // coarser)
        top = packed_counts(np.max([folded(r[5], groups) for r in rows], 0))
        return rows[0][0], None, rows[0][2], min(r[3] for r in rows), max(r[4] for r in rows), top, min(r[6] for r in rows), max(r[7] for r in rows)

    def sent(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        out["parent"] = pd.array([r[1] for r in rows], dtype="Int64")
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for b in batches:
            out = []
            for r in b[columns].itertuples(index=False, name=None):
                if held and (held[0][0] != r[0] or len(held) == FANOUT):
                    out.append(box(held))
                    held = []
                held.append(r)
                out.append((r[0], held[0][2], *r[2:]))
            yield sent(out)
        if held:
            yield sent([box(held)])

    lead = F.substring("top", 2, 16)
    dealt = entries.withColumn("parent", F.lit(0).cast("long")).select(columns).repartitionByRange("hub", "lo", lead, "item").sortWithinPartitions("hub", "lo", lead, "item")
    return dealt.mapInPandas(run, "hub long, parent long, item long, lo long, hi long, top binary, c0 long, c1 long")


def box_pairs(levels: list[DataFrame], least: int, held: list[DataFrame]) -> DataFrame:
    """hub, a, b: the boxes of points that pass the bound, from the top of the trees down. What is written on the way joins `held`."""
    start = lambda level: level.where("parent = 0").select("hub").distinct().select("hub", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    pairs = None
    for level in reversed(levels[1:]):
        # Hubs that end on this level start here, the others come from the level above.
        pairs = start(level) if pairs is None else pairs.unionByName(start(level))
        x, y = (level.select("hub", *(F.col(c).alias(f"{c}_{s}") for c in ("parent", "item", "lo", "hi", "top", "c0", "c1"))) for s in "xy")
        met = pairs.join(x.withColumnRenamed("parent_x", "a"), ["hub", "a"]).join(y.withColumnRenamed("parent_y", "b"), ["hub", "b"])
        met = met.where((F.col("a") != F.col("b")) | (F.col("item_x") <= F.col("item_y")))
        met = met.where(fits("hi_x", "lo_y", least) & fits("hi_y", "lo_x", least))
        met = met.where("not (c0_x = c1_x and c0_y = c1_y and c0_x = c0_y)")
        pairs = bounded(met, ["hub", "item_x", "item_y"], least).select("hub", F.col("item_x").alias("a"), F.col("item_y").alias("b"))
        pairs = cut(pairs)
        held.append(pairs)
    return pairs


def tree_join(points: DataFrame, least: int) -> DataFrame:
    """What may link, for each two boxes a and b of a hub (or one with itself): hub, a, b, sid, n, point, component, left, other.

    If few pairs of points pass the bound and are not in one component yet (SPARSE for each point), a row is a pair (sid,
    other; point is null). Else it is a point (other is null) that may link with one of the other box, so that a large
    group of near copies does not become all its pairs.

    points: hub, sid, n, point, component. Large hubs are boxed; their tree gets another level as long as one makes far
    fewer boxes: a task packs its own rows, so each of the shuffle's partitions adds a box at most.
    """
    partitions = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = points.select("hub", F.col("sid").alias("item"), F.col("n").alias("lo"), F.col("n").alias("hi"), F.col("point").alias("top"), F.col("component").alias("c0"), F.col("component").alias("c1"))
    held = []

    def more_than_a_box(entries: DataFrame) -> tuple[DataFrame, int]:
        large = cut(entries.groupBy("hub").agg(F.count("*").alias("m")).where(F.col("m") > FANOUT))
        held.append(large)
        return large, large.agg(F.sum("m")).first()[0] or 0

    member = F.struct(F.col("item").alias("sid"), F.col("lo").alias("n"), F.col("top").alias("point"), F.col("c0").alias("component"))
    zero, nothing = F.lit(0).cast("long"), F.lit(None)
    large, entries = more_than_a_box(top)
    # A hub of one box meets itself where its points are gathered.
    alone = top.join(large, "hub", "left_anti").groupBy("hub").agg(F.collect_list(member).alias("points_a"))
    kind = alone.schema["points_a"].dataType
    met = alone.select("hub", zero.alias("a"), zero.alias("b"), "points_a", nothing.cast(kind).alias("points_b"))
    if entries:
        both = cut(boxed(top.join(large, "hub", "left_semi"), COARSER))
        held.append(both)
        levels, top = [both.where("parent is not null")], both.where("parent is null").drop("parent")
        while True:
            large, entries = more_than_a_box(top)
            if entries <= 4 * partitions:
                levels.append(top.withColumn("parent", zero))
                break
            both = cut(boxed(top.join(large, "hub", "left_semi")))
            held.append(both)
            small = top.join(large, "hub", "left_anti")
            levels.append(both.where("parent is not null").unionByName(small.withColumn("parent", zero)))
            top = both.where("parent is null").drop("parent")
        pairs = box_pairs(levels, least, held)
        boxes = cut(levels[0].groupBy("hub", "parent").agg(F.collect_list(member).alias("points")))
        held.append(boxes)
        x, y = (boxes.select("hub", F.col("parent").alias(p), F.col("points").alias(f"points_{p}")) for p in "ab")
        met = met.unionByName(pairs.where("a = b").join(x, ["hub", "a"]).withColumn("points_b", nothing.cast(kind)))
        met = met.unionByName(pairs.where("a != b").join(x, ["hub", "a"]).join(y, ["hub", "b"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for hub, first, second, xs, ys in b[["hub", "a", "b", "points_a", "points_b"]].itertuples(index=False, name=None):
                ys = xs if first == second else ys
                may = may_link([(p["n"], p["point"], p["component"]) for p in xs], [(p["n"], p["point"], p["component"]) for p in ys], first == second, least)
                if may.sum() <= SPARSE * (len(xs) + len(ys)):
                    out += [(hub, first, second, xs[i]["sid"], 0, None, 0, True, ys[j]["sid"]) for i, j in np.argwhere(may)]
                    continue
                chosen = {p["sid"]: p for p in [*(p for p, m in zip(xs, may.any(1), strict=True) if m), *(p for p, m in zip(ys, may.any(0), strict=True) if m)]}
                out += [(hub, first, second, k, p["n"], p["point"], p["component"], any(k == q["sid"] for q in xs), None) for k, p in chosen.items()]
            found = pd.DataFrame(out, columns=["hub", "a", "b", "sid", "n", "point", "component", "left", "other"])
            yield found.assign(other=pd.array([r[8] for r in out], dtype="Int64"))

    kind = "hub long, a long, b long, sid long, n long, point binary, component long, left boolean, other long"
    out = cut(met.mapInPandas(run, kind))
    spent(*held)
    return out


def may_link(xs: list[tuple], ys: list[tuple], same: bool, least: int) -> np.ndarray:
    """A matrix: whether the bound and the sizes let (n, point, component) of xs and ys link, in different components; of one box with itself each pair once."""
    groups = min(groups_of(p) for _, p, _ in [*xs, *ys])
    px, py = (np.array([folded(p, groups) for _, p, _ in ps]) for ps in (xs, ys))
    n, m = (np.array([k for k, _, _ in ps]) for ps in (xs, ys))
    total = n[:, None] + m
    # Half the sum less half the distance is the sum of the minima.
    common = (px.sum(1)[:, None] + py.sum(1) - np.array([np.abs(py - row).sum(1) for row in px])) // 2
    may = (common >= needed(total, least)) & (100 * np.minimum(n[:, None], m) >= least * np.maximum(n[:, None], m))
    may &= np.array([c for _, _, c in xs])[:, None] != np.array([c for _, _, c in ys])
    return np.triu(may, 1) if same else may


def compare(members: DataFrame, reps: DataFrame, docs: DataFrame, text: str, key: str, least: int) -> DataFrame:
    """Links (a, b) between the members (see tree_join()) of each two boxes, by the exact overlap of their sets.

    A pair that links found before have put into one component is skipped, so that two boxes give fewer links than they have points.
    """
    cell = ["hub", "a", "b"]
    wanted = cut(members.select("sid").distinct().join(reps.select("sid", "row"), "sid"))
    texts = packed_texts(docs, wanted, key, text).select("row", "packed").join(wanted, "row").dropDuplicates(["sid"]).select("sid", "packed")
    rows = members.join(texts, "sid").repartition(*cell).sortWithinPartitions(*cell)

    def linked(held: list[tuple], same: bool) -> list[tuple[int, int]]:
        xs, ys = ([h for h in held if same or h[4] == side] for side in (True, False))
        if not xs or not ys:
            return []
        may = may_link([h[1:4] for h in xs], [h[1:4] for h in ys], same, least)
        over = {h[3]: h[3] for h in held}

        def root(c: int) -> int:
            while over[c] != c:
                over[c] = c = over[over[c]]
            return c

        out = []
        for i, j in np.argwhere(may):
            x, y = xs[i], ys[j]
            if root(x[3]) != root(y[3]) and len(np.intersect1d(x[5], y[5], assume_unique=True)) >= needed(x[1] + y[1], least):
                over[root(x[3])] = root(y[3])
                out.append((x[0], y[0]))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for b in batches:
            for part in portions(b, "packed", 1 << 18):
                out = []
                sets = shingle_sets(unpacked(part["packed"]))
                for hub, first, second, *rest in part[[*cell, "sid", "n", "point", "component", "left"]].itertuples(index=False, name=None):
                    if now != (hub, first, second):
                        out += linked(held, now[1] == now[2]) if now else []
                        now, held = (hub, first, second), []
                    held.append((*rest, next(sets)))
                yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
        if now:
            yield pd.DataFrame(linked(held, now[1] == now[2]), columns=["a", "b"], dtype=np.int64)

    out = cut(rows.mapInPandas(run, "a long, b long"))
    spent(wanted)
    return out


def verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, text: str, key: str, least: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by the exact overlap.

    Pairs of one a are compared together, so its text is sent once for many of them. An a of many pairs is dealt into
    cells by the hash of b: a cell holds about BLOCK texts, however many pairs there are. A task reads cell by cell, the
    texts of a cell before its pairs.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("wide"))
    dealt = cut(pairs.join(sizes, "a").select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("wide")).cast("int").alias("y"), "a", "b"))
    cell = ["hub", "y"]
    wanted = cut(dealt.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(reps.select("sid", "row"), "sid"))
    texts = packed_texts(docs, wanted, key, text).select("row", "packed").join(wanted, "row").dropDuplicates(["sid"]).select("sid", "packed")
    ends = dealt.select(*cell, F.explode(F.array("a", "b")).alias("sid")).distinct()
    sent = ends.join(texts, "sid").select(*cell, F.col("sid").alias("a"), F.lit(None).cast("long").alias("b"), "packed")
    rows = dealt.select(*cell, "a", "b", F.lit(None).cast("binary").alias("packed")).unionByName(sent)
    rows = rows.repartition(*cell).sortWithinPartitions(*cell, F.col("b").isNotNull(), "a").select(*cell, "a", F.coalesce("b", F.lit(0)).alias("b"), "packed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sets = None, {}
        for b in batches:
            for part in portions(b, "packed", 1 << 19):
                packed = part["packed"]
                new = shingle_sets(unpacked(packed[packed.notna()]))
                out = []
                for hub, y, a, c, data in part[[*cell, "a", "b", "packed"]].itertuples(index=False, name=None):
                    if now != (hub, y):
                        now, sets = (hub, y), {}
                    if data is not None:
                        sets[a] = next(new)
                    elif len(np.intersect1d(sets[a], sets[c], assume_unique=True)) >= needed(len(sets[a]) + len(sets[c]), least):
                        out.append((a, c))
                yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    out = cut(rows.mapInPandas(run, "a long, b long"))
    spent(dealt, wanted)
    return out


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node reachable) for edges (a, b): each round, all learn their neighbourhood's least, then its own.

    Edges are rewritten to point to the least of each neighbourhood (large star, small star), so that the number
    of rounds grows with the logarithm of a component's size.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        after_edges = cut(small.where("u != v").distinct())
        spent(edges, large)
        edges, after = after_edges, _state(after_edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, bits: int = 64) -> DataFrame:
    """row, late, id (see identity()), n (shingles), group: a number for each component, null for a row without words.

    One row for each row of docs. Equal sets are one class, known by 128 bits, whose pairs stand for all of its rows;
    rows that share a key but not the text are linked by their own texts.
    """
    made = cut(profiles(docs, hot_tokens(docs, docs.count(), text), text, key, least, bits))
    each = told_apart(made)
    reps = cut(each.where("sid is not null").groupBy("sid").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("point").alias("point")))
    members = cut(leaves(each.select("sid", "short", "usual", "prefix")))
    slim = cut(each.select("row", "late", "id", "n", "sid"))
    spent(made, *([each] if each is not made else []))
    # Sizes first, so that points are sent only for what they leave.
    stars = members
    for c, s in (("sid", "y"), ("hub", "x")):
        stars = stars.join(reps.select(F.col("sid").alias(c), F.col("n").alias(f"lo_{s}")), c)
    stars = stars.where(fits("lo_x", "lo_y", least) & fits("lo_y", "lo_x", least))
    for c, s in (("sid", "y"), ("hub", "x")):
        stars = stars.join(reps.select(F.col("sid").alias(c), F.col("point").alias(f"top_{s}")), c)
    stars = bounded(stars, ["hub", "sid"], least)
    stars = cut(stars.select(F.col("hub").alias("a"), F.col("sid").alias("b"), "hub"))
    links = verify(stars, reps, docs, text, key, least)
    spent(stars)
    known = cut(components(links))

    # In a hub whose sets are all in one component there is nothing left to find.
    own = members.join(known, F.col("sid") == F.col("node"), "left").select("hub", "sid", F.coalesce("component", "sid").alias("component"))
    mixed = own.groupBy("hub").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("m")).where("c0 != c1").select("hub", "m")
    own = cut(own.join(mixed, "hub").join(reps.select("sid", "n"), "sid"))
    few = with_peers(own.where(F.col("m") <= FANOUT), least)
    points = own.where(F.col("m") > FANOUT).drop("m").unionByName(few.drop("m")).join(reps.select("sid", "point"), "sid")
    points = cut(points.select("hub", "sid", "n", "point", "component"))
    spent(own)
    close = tree_join(points, least)
    spent(points, members)
    if not close.isEmpty():
        # One pair may be in many hubs; it is compared once, where its text of more pairs is.
        ends = F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")
        pairs = cut(close.where("other is not null").select(*ends).distinct())
        degree = cut(pairs.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("d")))
        both = pairs
        for c in "ab":
            both = both.join(degree.select(F.col("sid").alias(c), F.col("d").alias(f"d_{c}")), c)
        swap = F.col("d_b") > F.col("d_a")
        sparse = cut(both.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b")))
        more = verify(sparse, reps, docs, text, key, least)
        spent(pairs, degree)
        spent(sparse)
        dense = close.where("other is null").drop("other")
        if not dense.isEmpty():
            more = more.unionByName(compare(dense, reps, docs, text, key, least))
        known = cut(components(links.unionByName(more)))
    spent(close, links)
    return slim.join(known, F.col("sid") == F.col("node"), "left").select("row", "late", "id", "n", F.coalesce("component", "sid").alias("group"))


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, bits: int = 64) -> DataFrame:
    """key, n_shingles, component_id (least key reachable by links, itself included) of each row.

    Documents link when 100 * common shingles >= least * all shingles of both. Without words, null or empty, a document
    links with none. Repeated rows give repeated rows; of rows that share a key each is linked by its own text; a row with
    a null key links as any other, and has a null component only if no row of it has a key. Other columns are not carried
    along. Nothing is sampled or capped: all pairs of linked sets meet in a hub, where they are compared exactly or known
    to be in one component already. An empty table gives none.
    """
    rows = grouped(docs, text, key, least, bits)
    own = F.when(~F.col("late"), F.col("id"))
    least_id = rows.where("group is not null").groupBy("group").agg(F.min(own).alias("component_id"))
    out = rows.join(least_id, "group", "left")
    return out.select(own.alias(key), F.col("n").alias("n_shingles"), F.when(F.col("group").isNull(), own).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """docs without near duplicates: of each group of linked rows the one with the smallest key stays, once.

    A null key is the greatest; of rows with one key the smaller hash of key and text decides; rows without words all stay.
    """
    rows = cut(grouped(docs, text, key, least))
    first = rows.where("group is not null").groupBy("group").agg(F.min(F.struct("late", "id", "row"))["row"].alias("first"))
    name = unused(docs, "near")
    gone = cut(rows.join(first, "group").where("row != first").select(F.col("row").alias(name)).distinct())
    several = rows.where("group is not null").groupBy("row").agg(F.count("*").alias("times")).where("times > 1")
    spare = cut(several.select(F.col("row").alias(name)))
    left = docs.join(gone, row_of(key, text) == F.col(name), "left_anti")
    if spare.isEmpty():
        return left
    # Equal rows: all but one go. Only they are brought together.
    alone = left.join(spare, row_of(key, text) == F.col(name), "left_anti")
    return alone.unionByName(left.join(spare, row_of(key, text) == F.col(name), "left_semi").dropDuplicates([key, text]))
