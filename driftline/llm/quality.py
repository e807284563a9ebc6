"""Operator 10: quality rules with distribution divergence.

A document's histograms of character classes and of common words are compared to those of its language in the
whole corpus, by Jensen-Shannon distance; short texts are not judged that way. Every language that the corpus names
has a reference of character classes, those of COMMON one of words too. A document whose language has no reference
is never compared to another language: only the base rules can reject it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Common words of the languages that are also judged by words.
COMMON = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er aus bei nach wie".split(),
    "en": "the of and to in is that for was on are with as by this from it be or an at have which not you he his but".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ya".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus sur pas au ce il se ne sont avec son aux".split(),
}
#: Character classes by byte: lower case, upper case, digits, spaces, line ends, sentence marks, symbols, other ASCII, the rest.
CLASSES = 9
#: Verdict of the method: least characters and words for a judgement, greatest distances (0 to 1).
MIN_CHARS, MIN_WORDS, MAX_CHAR_JSD, MAX_WORD_JSD = 200, 50, 0.31, 0.42
#: Languages that a task sums up before it sends them; bounds its memory if `lang` holds arbitrary values.
HELD = 1000


def _class_of() -> np.ndarray:
    out = np.full(256, 8, np.uint8)
    out[:128] = 7
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\v\f", ".,;:?'\"()-", "#*$%&|<>!@^~_=+")):
        out[[ord(c) for c in chars]] = k
    return out


CLASS_OF = _class_of()
_GAPS, _SYMBOLS, _CONTINUED = [9, 10, 11, 12, 13, 32], [ord(c) for c in "#*$%&|<>"], slice(0x80, 0xC0)
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _word_histogram(words: list[bytes], places: dict[bytes, int], n: int) -> np.ndarray:
    """Counts of the common words, all others last."""
    out = np.zeros(n + 1)
    for w in words:
        out[places.get(w.translate(_FOLD, b".,;:?!"), n)] += 1
    return out


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2: 0 to 1) of two histograms; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda a: float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum())
    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(ids)
    pair = a[:-2] * n + a[1:-1]
    if n > 1_000_000:  # keep the product of three below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, counts = np.unique(pair * n + a[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(a), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[int, int, int, int, int, np.ndarray, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, character classes, words."""
    data = text.encode()
    words = data.split()
    each = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(each.sum() - each[_CONTINUED].sum() - each[_GAPS].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    classes = np.bincount(CLASS_OF, weights=each, minlength=CLASSES)
    return len(words), chars, int(each[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(words), classes, words


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(character classes, common words) of each language named in the corpus, over all its documents with a text.

    A language outside COMMON has no common words: its second histogram is empty. Each task sends its sums only: a few
    numbers for each language.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chars: dict[str, np.ndarray] = {}
        common = {k: np.zeros(len(ws) + 1) for k, ws in COMMON.items()}
        places = {k: {w.encode(): i for i, w in enumerate(ws)} for k, ws in COMMON.items()}

        def sent(kind: str, found: dict[str, np.ndarray]) -> pd.DataFrame:
            rows = [(k, kind, i, n) for k, h in found.items() for i, n in enumerate(h)]
            return pd.DataFrame(rows, columns=["lang", "kind", "i", "n"])

        for b in batches:
            for k, t in zip(b["lang"], b["text"], strict=True):
                data = t.encode()
                if k not in chars and len(chars) >= HELD:
                    yield sent("c", chars)
                    chars = {}
                each = np.bincount(CLASS_OF, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=CLASSES)
                chars[k] = chars[k] + each if k in chars else each
                if k in common:
                    common[k] += _word_histogram(data.split(), places[k], len(COMMON[k]))
        yield sent("c", chars)
        yield sent("w", common)

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    out: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for r in rows.mapInPandas(sums, "lang string, kind string, i int, n double").groupBy("lang", "kind", "i").agg(F.sum("n").alias("n")).collect():
        own = out.setdefault(r["lang"], (np.zeros(CLASSES), np.zeros(len(COMMON[r["lang"]]) + 1 if r["lang"] in COMMON else 0)))
        own[r["kind"] == "w"][r["i"]] = r["n"]
    return {k: own for k, own in out.items() if own[0].any()}


def judge(spark: SparkSession, docs: DataFrame, refs: dict | None = None, text: str = "text", lang: str = "lang", out: str = "quality") -> DataFrame:
    """docs with a struct column `out` (quality): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_jsd, word_jsd, kept.

    A document without language or of one without a reference (given refs can lack some) has distances 0 and is kept
    unless the base rules fail; so has one outside COMMON a word_jsd of 0. A null text counts as empty (fails the base
    rule). A language written in two scripts has one reference; its rarer script may lie far from it. Whole texts; repeated rows are judged each, alike; an existing column `out`
    is replaced. Two passes over the texts (references, verdicts), no shuffle of texts.
    """
    refs = references(docs, text, lang) if refs is None else refs
    places = {k: {w.encode(): i for i, w in enumerate(ws)} for k, ws in COMMON.items()}

    def near(k: str, classes: np.ndarray, words: list[bytes]) -> tuple[float, float]:
        chars, common = refs[k]
        return distance(classes, chars), distance(_word_histogram(words, places[k], len(COMMON[k])), common) if k in places else 0.0

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_jsd double, word_jsd double, kept boolean")
    def run(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        rows = []
        for t, k in zip(texts, langs, strict=True):
            n, chars, symbols, dups, again, classes, words = measure(t or "")
            failed, far = n < 50 or 100 * again > 50 * n, (0.0, 0.0)
            if n >= MIN_WORDS and chars >= MIN_CHARS and k in refs:
                far = near(k, classes, words)
            rows.append((n, chars, symbols, dups, again, failed, *far, not failed and far[0] <= MAX_CHAR_JSD and far[1] <= MAX_WORD_JSD))
        return pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_jsd", "word_jsd", "kept"])

    return docs.withColumn(out, run(F.col(text), F.col(lang)))
