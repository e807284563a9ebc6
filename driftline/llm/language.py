"""Operator 5: language identification by prediction by partial matching.

For each language a variable-order byte context tree (order 3 down to 0) with escape probabilities (method C,
without exclusion) is learned and frozen. A text's code length in bits under each tree decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.llm.common import cut, unused

#: Byte symbols: 0 is the start of a text (and NUL), 1 to 62 the commonest bytes of the sample, 63 all others.
SYMBOLS, OTHER = 64, 63
ORDER = 3
#: Training texts of each language, expected; the sample is bounded by it and by nothing else.
SAMPLE_DOCS = 1000
#: Bytes scored at once in a worker.
STEP = 1 << 20


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, A-Z lower-cased, each text after ORDER zero bytes; length of each with its zeros)."""
    parts = [b"\0" * ORDER + t.encode().lower() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)


def _contexts(sym: np.ndarray) -> np.ndarray:
    """For each position from ORDER on, the three symbols before it as one number."""
    s = sym.astype(np.int32)
    return s[:-3] << 12 | s[1:-2] << 6 | s[2:-1]


class Trees:
    """Frozen context trees of all languages as tables of bits: rows of order 2 first, then seen contexts of order 3."""

    def __init__(self, languages: list[str], symbol_of: np.ndarray, grams: pd.DataFrame) -> None:
        self.languages, self.symbol_of = languages, symbol_of
        if not languages:
            return
        contexts = np.unique(grams["gram"].to_numpy() >> 6) if len(grams) else np.zeros(0, np.int64)
        self.row_of = (np.arange(SYMBOLS**3) & (SYMBOLS**2 - 1)).astype(np.int32)
        self.row_of[contexts] = SYMBOLS**2 + np.arange(len(contexts), dtype=np.int32)
        bits = np.empty((SYMBOLS**2 + len(contexts), SYMBOLS, len(languages)), np.float32)
        for k, lang in enumerate(languages):
            own = grams[grams["lang"] == lang]
            third = np.zeros((len(contexts), SYMBOLS))
            gram, n = own["gram"].to_numpy(), own["n"].to_numpy()
            np.add.at(third, (np.searchsorted(contexts, gram >> 6), gram & 63), n)
            second = np.zeros((SYMBOLS**2, SYMBOLS))
            np.add.at(second, (gram >> 6 & (SYMBOLS**2 - 1), gram & 63), n)
            first = second.reshape(SYMBOLS, SYMBOLS, SYMBOLS).sum(0)
            p = self._mix(first.sum(0)[None], np.full((1, SYMBOLS), 1 / SYMBOLS))
            p = self._mix(first, np.repeat(p, SYMBOLS, 0))
            p = self._mix(second, np.tile(p, (SYMBOLS, 1)))
            bits[: SYMBOLS**2, :, k] = -np.log2(p)
            bits[SYMBOLS**2 :, :, k] = -np.log2(self._mix(third, p[contexts & (SYMBOLS**2 - 1)]))
        bits[:, 0] = 0  # what marks a start costs nothing
        self.bits = bits.reshape(-1, len(languages))

    @staticmethod
    def _mix(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Seen symbols by their share, all others by the escape times the shorter context's; an unseen context is skipped."""
        n, d = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        total = np.maximum(n + d, 1)
        return np.where(counts > 0, counts / total, np.where(n > 0, d / total, 1) * lower)

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text under each language."""
        buf, lengths = _buffer(texts)
        out = np.zeros((len(texts), len(self.languages)))
        of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        for a in range(ORDER, len(buf), STEP):
            sym = self.symbol_of[buf[a - ORDER : a + STEP]]
            cost = self.bits[self.row_of[_contexts(sym)] * SYMBOLS + sym[ORDER:]]
            docs = of[a : a + STEP]
            first, last = docs[0], docs[-1]
            for k in range(cost.shape[1]):
                out[first : last + 1, k] += np.bincount(docs - first, weights=cost[:, k], minlength=last - first + 1)
        return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Trees:
    """Learn from a sample of rows with text and language: about sample_docs whole texts of each language, all if fewer.

    Rows are taken by a hash of `key`, so that the sample is the same every time. What reaches the driver is
    bounded by the sample: its byte counts and its four-symbol counts of each language.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Trees([], np.zeros(256, np.uint8), pd.DataFrame({"lang": [], "gram": np.zeros(0, np.int64), "n": []}))
    share = docs.sparkSession.createDataFrame([(k, int(min(1.0, sample_docs / n) * (1 << 30))) for k, n in counts.items()], "_lang string, _share long")
    pick = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < F.col("_share")
    sample = cut(rows.join(F.broadcast(share), F.col(lang) == F.col("_lang")).where(pick).select(F.col("_lang").alias("lang"), F.col(text).alias("text")))

    def byte_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = np.bincount(_buffer(list(b["text"]))[0], minlength=256)
            yield pd.DataFrame({"byte": np.arange(256), "n": n})

    total = np.zeros(256, np.int64)
    for r in sample.mapInPandas(byte_counts, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        total[r["byte"]] = r["n"]
    total[0] = 0
    symbol_of = np.full(256, OTHER, np.uint8)
    symbol_of[0] = 0
    common = sorted(np.flatnonzero(total), key=lambda b: (-total[b], b))[: OTHER - 1]
    symbol_of[common] = np.arange(1, len(common) + 1)

    def gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, part in b.groupby("lang"):
                sym = symbol_of[_buffer(list(part["text"]))[0]]
                gram = _contexts(sym) << 6 | sym[ORDER:]
                gram, n = np.unique(gram[(gram & 63) > 0], return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": gram.astype(np.int64), "n": n})

    grams = sample.mapInPandas(gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return Trees(sorted(counts), symbol_of, grams.astype({"gram": np.int64}))


def identify(spark: SparkSession, docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (the share of the best language among all, from the code lengths).

    `und` with score 0 for a null text, one without a letter, or trees without a language. Ties go to the
    language first in the alphabet. Whole texts of any length; repeated rows are judged each; existing columns
    of these names are replaced. The trees are at most 64**3 contexts of 64 symbols for each language, in
    practice a few MB; they are broadcast. No shuffle.
    """
    shared = spark.sparkContext.broadcast(trees)
    letter = regex.compile(r"\p{L}").search

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        trees, rows = shared.value, [t or "" for t in texts]
        if not trees.languages:
            return pd.DataFrame({"lang_pred": ["und"] * len(rows), "score": 0.0})
        bits = trees.code_lengths(rows)
        best = bits.argmin(1)
        share = 1 / np.exp2(np.clip(bits.min(1)[:, None] - bits, -1000, 0)).sum(1)
        known = np.array([letter(t) is not None for t in rows], bool)
        names = np.array(trees.languages, object)
        return pd.DataFrame({"lang_pred": np.where(known, names[best], "und"), "score": np.where(known, share, 0.0)})

    r = unused(docs, "r")
    return docs.withColumn(r, run(text)).withColumns({"lang_pred": F.col(f"{r}.lang_pred"), "score": F.col(f"{r}.score")}).drop(r)
