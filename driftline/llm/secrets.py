"""Operator 8: secret scans with Spark expressions only.

Fixed patterns give base spans. Beside them, candidate strings are judged by the Shannon entropy of a sliding
window, whose character counts are kept as the window moves; an allow-list suppresses known harmless ones.
The time is linear in the text, however long a candidate is and however many spans are found.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from driftline.llm.common import unused

#: The base patterns. Group 2 of `assign` is the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is long enough is matched whole from its start, so the least length can stand in the pattern.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
#: Entropy scan: candidates, window, and the characters and least bits a character of each class (the first that fits counts).
CANDIDATE, WINDOW = r"[A-Za-z0-9+/_=-]{20,}", 20
CLASSES = (("entropy_hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0), ("entropy_base36", r"^([0-9a-z]+|[0-9A-Z]+)$", 3.7), ("entropy_base64", r"", 3.7))
KINDS = ("assign", "access", "hex", *(k for k, _, _ in CLASSES))
ALLOW = r"(?i)example|sample|dummy|placeholder|changeme|0123456789|abcdefgh|(.)\1{7}|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
#: Counts of a window are kept LANE bits each, PACKED of them in a number.
LANE, PACKED = 5, 12
#: Elements that a running total handles at once, and spans up to which mask() takes substrings of the text.
CHUNK, FEW = 256, 64
SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int,value:string>>"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(numbers: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The running totals of an array of numbers from 0 on, by `step` (a sum, a maximum); each chunk's total first, then within chunks.

    A single fold would copy the result for each element.
    """

    def fold(xs: Column, start: Column) -> Column:
        grow = lambda a, x: bind(step(a["at"], x), lambda v: F.struct(v.alias("at"), F.array_append(a["all"], v).alias("all")))
        return F.aggregate(xs, F.struct(start.alias("at"), F.expr("cast(array() as array<int>)").alias("all")), grow, lambda a: a["all"])

    def whole(xs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")), lambda k: F.slice(xs, k * CHUNK + 1, F.lit(CHUNK)))
        totals = lambda cs: F.transform(cs, lambda c: F.aggregate(c, F.lit(0), step))
        ends = lambda cs: fold(totals(cs), F.lit(0))
        return bind(chunks, lambda cs: bind(ends(cs), lambda e: F.flatten(F.transform(cs, lambda c, k: fold(c, F.when(k > 0, F.get(e, k - 1)).otherwise(0))))))

    return bind(numbers, lambda xs: F.when(F.size(xs) == 0, F.expr("cast(array() as array<int>)")).when(F.size(xs) <= CHUNK, fold(xs, F.lit(0))).otherwise(whole(xs)))


def found(text: Column, pattern: str, kind: Column, value: Column) -> Column:
    """Spans of all matches in text, from the lengths of the matches and of what lies between them."""
    lengths = lambda xs: F.transform(xs, lambda x: F.length(x))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(gaps: Column, own: Column) -> Column:
        ends = running(F.transform(own, lambda n, i: n + F.get(gaps, i)), lambda a, x: a + x)
        each = F.arrays_zip(own.alias("n"), ends.alias("end"), value.alias("value"))
        return F.transform(each, lambda p: F.struct((p["end"] - p["n"]).alias("start"), F.lit(0).alias("kind_no"), kind.alias("kind"), p["end"].alias("end"), p["value"].alias("value")))

    return bind(lengths(F.split(text, pattern, -1)), lambda gaps: bind(lengths(hits), lambda own: spans(gaps, own)))


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """The greatest Shannon entropy, in bits a character, of any window of s (characters of ALPHABET).

    The counts of the window's characters are packed into numbers; a step adds one to the count of the character that
    comes and takes one from that of the one that goes. sum is the total of c * log2(c) over the counts, of which a step
    changes two terms.
    """
    lanes = range(-(-len(ALPHABET) // PACKED))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    term = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)

    def count(a: Column, x: Column) -> Column:
        held = reduce(lambda c, k: c.when(x["lane"] == k, a[f"c{k}"]), list(lanes)[1:], F.when(x["lane"] == 0, a["c0"]))
        return F.call_function("shiftright", held, x["bit"]).bitwiseAND(F.lit((1 << LANE) - 1))

    def moved(a: Column, x: Column, by: Column) -> list[Column]:
        return [(a[f"c{k}"] + F.when(x["lane"] == k, by).otherwise(none)).alias(f"c{k}") for k in lanes]

    def goes(a: Column, x: Column) -> Column:
        less = lambda n: F.struct(*moved(a, x, -F.call_function("shiftleft", one, x["bit"])), (a["sum"] - term(n) + term(n - 1)).alias("sum"), a["best"].alias("best"))
        return F.when(x.isNull(), F.struct(*(a[f"c{k}"].alias(f"c{k}") for k in lanes), a["sum"].alias("sum"), a["best"].alias("best"))).otherwise(bind(count(a, x), less))

    def comes(a: Column, x: Column, full: Column) -> Column:
        def more(n: Column) -> Column:
            total = a["sum"] + term(n + 1) - term(n)
            bits = F.log2(F.lit(float(window))) - total / window
            return F.struct(*moved(a, x, F.call_function("shiftleft", one, x["bit"])), total.alias("sum"), F.when(full, F.greatest(a["best"], bits)).otherwise(a["best"]).alias("best"))

        return bind(count(a, x), more)

    place = lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1
    symbols = F.transform(F.split(s, ""), lambda c: bind(place(c), lambda p: F.struct(F.floor(p / PACKED).cast("int").alias("lane"), (p % PACKED * LANE).cast("int").alias("bit"))))
    start = F.struct(*(none.alias(f"c{k}") for k in lanes), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def slide(xs: Column) -> Column:
        pairs = F.transform(xs, lambda x, i: F.struct(x.alias("come"), F.when(i >= window, F.get(xs, i - window)).alias("go"), (i >= window - 1).alias("full")))
        return F.aggregate(pairs, start, lambda a, p: bind(goes(a, p["go"]), lambda b: comes(b, p["come"], p["full"])), lambda a: a["best"])

    return bind(symbols, slide)


def scan(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with a column of spans, array<struct<start, kind_no, kind, end, value>>, by start, kind and end.

    start counts code points from 0, end is exclusive; value is the text found (for assign: what is assigned).
    Base kinds come first of equal starts; spans of different kinds may overlap. A null or empty text has none;
    texts of any length are scanned whole; repeated rows each; an existing column `out` is replaced. No shuffle.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.expr(f"cast(array() as {SPAN})")
    hits = lambda pattern, group=0: F.regexp_extract_all(t, F.lit(pattern), F.lit(group))
    assign = F.filter(found(t, ASSIGN, F.lit("assign"), hits(ASSIGN, 2)), lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    access, hexes = (found(t, p, F.lit(k), hits(p)) for p, k in ((ACCESS, "access"), (HEX, "hex")))
    named = lambda v: reduce(lambda c, x: c.when(v.rlike(x[1]), x[0]), CLASSES[1:], F.when(v.rlike(CLASSES[0][1]), CLASSES[0][0]))
    least = lambda k: reduce(lambda c, x: c.when(k == x[0], x[2]), CLASSES[1:], F.when(k == CLASSES[0][0], CLASSES[0][2]))
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike(ALLOW)
    likely = F.filter(found(t, CANDIDATE, F.lit(""), hits(CANDIDATE)), lambda s: mixed(s["value"]))
    classed = F.transform(likely, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind_no"), named(s["value"]).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    entropy = F.filter(classed, lambda s: window_entropy(s["value"]) >= least(s["kind"]))
    each = [F.when(t.rlike(p), x).otherwise(none) for p, x in ((ASSIGN, assign), (ACCESS, access), (HEX, hexes), (CANDIDATE, entropy))]
    number = F.array(*map(F.lit, KINDS))
    numbered = lambda s: F.struct(s["start"].alias("start"), (F.array_position(number, s["kind"]).cast("int") - 1).alias("kind_no"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))
    return docs.withColumn(out, F.array_sort(F.transform(F.concat(*each), numbered)))


def digest(scanned: DataFrame, spans: str = "secrets") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", *map(count, KINDS[:3]), F.sha2(line(F.filter(spans, lambda s: s["kind_no"] < 3)).cast("binary"), 256).alias("base_sha256"), line(F.col(spans)).alias("spans"))


def mask(docs: DataFrame, text: str = "text", by: str = "[SECRET]") -> DataFrame:
    """docs with each secret's span replaced by `by`; overlapping spans are replaced once. Other texts stay as they are."""
    t, own = F.col(text), unused(docs, "spans")
    parts = lambda at, n: F.substr(t, at + 1, n)

    def built(part: Callable[[Column, Column], Column]) -> Column:
        # `before` is where the spans so far end; what a span adds is the text since then and the mask, unless they overlap.
        ends = running(F.transform(own, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        before = lambda e: F.slice(F.concat(F.array(F.lit(0)), e), F.lit(1), F.size(e))
        piece = lambda s, a: F.when(s["start"] >= a, F.concat(part(a, s["start"] - a), F.lit(by))).otherwise("")
        pieces = lambda e: F.array_join(F.zip_with(own, before(e), piece), "")
        return bind(ends, lambda e: F.concat(pieces(e), part(F.element_at(e, -1), F.length(t))))

    # A substring is found by walking from the start of the text, so of many spans the text is split once.
    many = bind(F.split(t, ""), lambda chars: built(lambda at, n: F.array_join(F.slice(chars, at + 1, F.greatest(n, F.lit(0))), "")))
    scanned = scan(docs, text, own)
    return scanned.withColumn(text, F.when(F.size(own) == 0, t).when(F.size(own) <= FEW, built(parts)).otherwise(many)).drop(own)
