"""Files of ids, phrases and aligned tokens against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import tempfile
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
import sentencepiece
from pyspark.sql import Row, functions as F
from tokenizers import Tokenizer

from driftline.llm import alignment, collocations, queries, repair, token_files
from driftline.llm.bpe import byte_chars

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in (queries.WORD_TOKENIZER, queries.TOKENIZER, queries.PIECE_TOKENIZER))
ODD = [
    "<|endoftext|> x", "a<|startoftext|>b c <|ENDOFTEXT|>", "İstanbul ΣΑΣ é. ǅ, ¿qué? \x1ca\x1db\x85c d e", "''s it's 'ST. 12,5 a.b,c). OF!!",
    "é. ́a a ́b", "日本語。テキスト. 😀😀.", "½. Ⅷ. ²,", "", None, " ", "  two  spaces \n\n\tand  ", "▁ under ▁", "�\x00 zero", "<s> </s> <unk> <0x41>", "x" * 5000, "ab " * 4000,
]


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, start long, ids string, at int, n long")


def odd_docs(spark):
    rows = [(k * 3, t, "xx", 1, "y", 2, 3) for k, t in enumerate(ODD)]
    return frame(spark, [*rows, rows[0], rows[0], (3, "other text of the same id", None, 1, "y", 2, 3), (None, "no id", "", 1, None, 2, 3), (None, "no id", "", 1, None, 2, 3)])


@pytest.mark.parametrize("terminals", [300, 70_000])
@pytest.mark.parametrize("ids", [[], [5], [7] * 1001, [1, 2] * 50, list(range(100)) * 30, [1, 1, 2] * 400 + [1, 1, 1, 2] * 300])
def test_grammar_gives_back_all_ids_and_any_stretch(ids, terminals):
    g = repair.compress(np.array(ids, np.int32), terminals)
    assert g.ids().tolist() == ids
    assert all((g.rules[k] < terminals + k).all() for k in range(len(g.rules)))
    assert g.lengths.tolist() == [len(g.expand(np.array([terminals + k], g.symbols.dtype))) for k in range(len(g.rules))]
    for a, b in ((0, 1), (3, 9), (len(ids) // 2, len(ids)), (len(ids), len(ids))):
        assert g.stretch(a, b).tolist() == ids[a:b]
    if len(ids) > 500:
        assert len(g.symbols) + 2 * len(g.rules) < len(ids) / 4


def test_grammar_of_random_ids():
    rng = np.random.default_rng(5)
    for n, most in ((5000, 3), (20000, 40), (20000, 49000)):
        ids = rng.integers(0, most, n)
        g = repair.compress(ids, 49408)
        assert (g.ids() == ids).all()
        pairs = Counter(zip(g.symbols.tolist(), g.symbols[1:].tolist(), strict=False))
        assert max(n for (a, b), n in pairs.items() if a != b) < 3 * repair.LEAST


def by_library(rows):
    t = Tokenizer.from_file(WORDS)
    at = 0
    for doc, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc, at, ids
        at += len(ids)


@pytest.mark.parametrize("shard", [50, 1 << 20])
def test_files_hold_what_the_library_gives(spark, shard):
    path = tempfile.mkdtemp() + "/ids"
    docs = odd_docs(spark)
    token_files.write(docs, path, WORDS, 2, shard=shard)
    got = token_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect() if r.doc_id is not None)) + [None, None]
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    t, at = Tokenizer.from_file(WORDS), 0
    for r in got:
        ids = [*t.encode(text := next(x for x in texts[r.doc_id] if [*t.encode(x, add_special_tokens=False).ids, 2] == r.ids), add_special_tokens=False).ids, 2]
        texts[r.doc_id].remove(text)
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids)
        at += len(ids)
    sums = {r.start: r for r in token_files.checksums(spark, path).collect()}
    assert all(sums[r.start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    wanted = spark.createDataFrame([(3,), (45,), (45,), (None,), (99,)], "doc_id long")
    assert sorted(map(tuple, token_files.fetch(spark, path, wanted).collect())) == sorted(tuple(r) for r in got if r.doc_id in (3, 45))


def test_files_of_an_empty_table(spark):
    path = tempfile.mkdtemp() + "/ids"
    token_files.write(frame(spark, []), path, WORDS, 2)
    assert token_files.read(spark, path).count() == token_files.checksums(spark, path).count() == 0
    assert token_files.fetch(spark, path, spark.range(3).toDF("doc_id")).count() == 0


def test_files_of_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {(d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, at, ids in by_library(sorted(map(tuple, docs)))}
    assert {tuple(r) for r in queries.op11_token_files(spark, sf_dir).collect()} == want


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with open(BYTES, "rb") as f, pytest.raises(ValueError):
        token_files.Encoder(f.read())


def align_by_hand(texts):
    t, sp = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t.encode_special_tokens = True
    token, of = {i: w for w, i in t.get_vocab().items()}, byte_chars()
    counts, out = Counter(), []
    for text in texts:
        a, b = (t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        raw_a = [bytes(of[c] for c in token[i]) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            out.append(None)
            continue
        end_a, end_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        groups, links, before = [], [], 0
        of_a, of_b = dict(zip(end_a, a, strict=True)), dict(zip(end_b, b, strict=True))
        for c in sorted(of_a.keys() & of_b.keys()):
            part = lambda of, lo=before, hi=c: ",".join(str(i) for e, i in of.items() if lo < e <= hi)
            groups.append(part(of_a) + "|" + part(of_b)) if len(text) < 3000 else groups.append(None)
            links.append((of_a[c], of_b[c]))
            before = c
        counts.update(links)
        out.append((a, b, groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for r in out:
        if r is None:
            yield 0, 0, 0, 0, 0, 0, ""
            continue
        a, b, groups, links = r
        sha = None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest()
        yield len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha


@pytest.mark.parametrize("block", [300, 1 << 22])
def test_alignment_by_hand(spark, monkeypatch, block):
    docs = odd_docs(spark)
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "PORTION", block // 3)
    rows = docs.collect()
    known = {}
    for text, want in zip([r.text for r in rows], align_by_hand([r.text for r in rows]), strict=True):
        known[text] = want
    got = alignment.align(spark, docs, BYTES, PIECES).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in rows)
    ids = {r.doc_id: r for r in got}
    for k, text in enumerate(ODD[1:], 1):
        if k != 1:
            want = known[text]
            assert tuple(ids[k * 3])[1 : 7 if want[6] is None else 8] == want[: 6 if want[6] is None else 7], text


def test_alignment_of_whole_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_alignment(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r, want in zip(rows, align_by_hand([r.text for r in rows]), strict=True):
        assert got[r.doc_id][: 6 if want[6] is None else 7] == want[: 6 if want[6] is None else 7]
    assert alignment.align(spark, frame(spark, []), BYTES, PIECES).count() == 0


def test_blocks_are_written_in_small_pieces(spark, monkeypatch):
    """A task's blocks are no single row group, which would be read whole, and a link takes less than two bytes."""
    monkeypatch.setattr(alignment, "BLOCK", 20_000)
    monkeypatch.setattr(alignment, "GATHERED", 1 << 15, raising=False)
    kept, cut = [], alignment.cut
    monkeypatch.setattr(alignment, "cut", lambda *a: kept.append(cut(*a)) or kept[-1])
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).coalesce(1)
    got = alignment.align(spark, docs, BYTES, PIECES).collect()
    files = [pq.ParquetFile(p).metadata for p in Path(kept[0].cut_path.removeprefix("file:")).glob("*.parquet")]
    sizes = [m.row_group(g).total_byte_size for m in files for g in range(m.num_row_groups)]
    assert len(got) == 300 and sum(m.num_rows for m in files) > 20
    assert len(sizes) > 5 and max(sizes) < 1 << 17
    assert kept[0].agg(F.sum(F.length("links"))).first()[0] < 2 * sum(r.n_links for r in got)


@pytest.mark.parametrize("n", [0, 1, 1 << 16, (1 << 16) + 1])
def test_places_of_any_number_of_pairs(n):
    keys, pairs = np.random.default_rng(n).permutation(n), alignment._Pairs()
    keys = np.concatenate([keys, keys[: n // 3]])
    for half in (keys[: n // 2], keys[n // 2 :]):
        pairs.add((half + 7).astype(np.int32), (half % 1000).astype(np.int32))
    a, b, count, packed = pairs.close()
    places = alignment._places(packed, len(a))
    assert len(a) == n and (a[places] == keys + 7).all() and (b[places] == keys % 1000).all()
    assert (np.bincount(places, minlength=n) == count).all()


def test_overlaps_share_their_bytes(spark):
    docs = frame(spark, [(4, "héllo wörld", None, 0, "", 0, 0), (None, "日本 a", None, 0, "", 0, 0), (6, None, None, 0, "", 0, 0)])
    got = alignment.overlaps(spark, docs, BYTES, PIECES).collect()
    for doc, text in ((4, "héllo wörld"), (None, "日本 a")):
        of = [r for r in got if r.doc_id == doc]
        assert sum(r.bytes for r in of) == len(text.encode()) + 1 and all(r.bytes > 0 for r in of)
        assert min(r.a_i for r in of) == min(r.b_i for r in of) == 0
    assert {r.doc_id for r in got} == {4, None}


def phrases_by_hand(rows, least):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    out = set()
    for (lang, p), a in often.items():
        if len(p) == 1 or any(la == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (la, q), b in often.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.add((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return out


def test_phrases_by_hand(spark):
    rows = [("New York, new york! In New York city; in new  york\tcity. x\x0by", "en"), (None, "en"), ("", None), ("a a a a a a", None), ("NEW YORK É é", ""), ("\x00 zero \x00 zero", "en")] * 3
    docs = frame(spark, [(k, t, lang, 0, "", 0, 0) for k, (t, lang) in enumerate(rows)])
    found, sizes = collocations.phrases(docs, least=3)
    got = {tuple(r) for r in found.join(sizes, "lang").select("lang", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == phrases_by_hand(rows, 3)
    assert collocations.best(frame(spark, [])).count() == 0


def test_phrases_of_small_blocks_and_parts(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = sorted(map(tuple, collocations.best(docs, top=500).collect()))
    monkeypatch.setattr(collocations, "BLOCK", 20_000)
    monkeypatch.setattr(collocations, "PART", 5_000)
    monkeypatch.setattr(collocations, "GATHERED", 3_000)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 12)  # a filter too small lets more through, nothing less
    assert sorted(map(tuple, collocations.best(docs, top=500).collect())) == whole


def test_blocks_of_words_are_written_in_small_pieces(spark, monkeypatch):
    """A task's blocks are no single row group, which would be read whole, and a place takes about two bytes at most."""
    monkeypatch.setattr(collocations, "BLOCK", 20_000)
    monkeypatch.setattr(collocations, "WRITTEN", 1 << 15, raising=False)
    kept, cut = [], collocations.cut
    monkeypatch.setattr(collocations, "cut", lambda *a: kept.append(cut(*a)) or kept[-1])
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).coalesce(1)
    collocations.phrases(docs)
    files = [pq.ParquetFile(p).metadata for p in Path(kept[0].cut_path.removeprefix("file:")).glob("*.parquet")]
    sizes = [m.row_group(g).total_byte_size for m in files for g in range(m.num_row_groups)]
    assert sum(m.num_rows for m in files) > 10 and len(sizes) > 5 and max(sizes) < 1 << 17
    held = kept[0].agg(F.sum(F.length("index")), F.sum(F.expr("aggregate(counts, 0L, (x, y) -> x + y)"))).first()
    assert held[0] < 2.2 * held[1]


def test_a_pair_leaves_a_task_once_for_all_its_blocks(spark, monkeypatch):
    """Neither Spark's rows nor the pairs in them grow with the number of blocks that hold a pair."""
    monkeypatch.setattr(collocations, "BLOCK", 100)
    sent, levels = [], collocations._levels
    monkeypatch.setattr(collocations, "_levels", lambda *a: sent.append(levels(*a)) or sent[-1])
    rows = [(" ".join(f"w{k % 20}" for k in range(40)), "en")] * 60
    docs = frame(spark, [(k, *row, 0, "", 0, 0) for k, row in enumerate(rows)]).coalesce(1)
    assert collocations.blocks(docs).count() == 60
    found, sizes = collocations.phrases(docs)
    assert {tuple(r) for r in found.join(sizes, "lang").select("lang", "phrase", "a", "l", "r", "n", "score").collect()} == phrases_by_hand(rows, 30)
    for k in (1, 3, 5):
        packed = sent[k].collect()
        assert len(packed) == 1 and len(collocations._numbers(packed[0].counts, np.int64)) == 20


def test_a_rare_pair_with_the_name_of_a_frequent_one_is_found(spark, monkeypatch):
    docs = frame(spark, [(k, t, "en", 0, "", 0, 0) for k, t in enumerate(["one two"] * 5 + ["two one"])])
    assert [r.phrase for r in collocations.phrases(docs, least=5)[0].collect()] == ["one two"]
    monkeypatch.setattr(collocations, "_mixed", lambda left, right: np.zeros(len(left), np.uint64))
    with pytest.raises(collocations.Clash):
        collocations.phrases(docs, least=5)


@pytest.mark.parametrize("n", [1, 100_000])
def test_names_in_order_take_few_bytes(n):
    names = np.sort(np.random.default_rng(n).integers(0, 1 << collocations.SHORT, n, np.uint64))
    names[-1] = (1 << collocations.SHORT) - 1
    packed = collocations._planes(np.diff(names, prepend=np.uint64(0)))
    assert (np.cumsum(collocations._numbers(packed, np.uint64)) == names).all() and len(packed) < 5 * n + 100
    counts = np.arange(n, dtype=np.int32) ** 2
    assert (collocations._numbers(collocations._planes(counts), np.int32) == counts).all()


def test_blocks_of_many_languages_are_closed(spark, monkeypatch):
    """A task with more languages than it holds blocks of still sends them, and no word is lost or counted for another language."""
    monkeypatch.setattr(collocations, "BLOCK", 1_000)
    rows = [(k, f"w{k % 7} é same " * 8, f"l{k % 50}", 0, "", 0, 0) for k in range(400)]
    found = collocations.blocks(frame(spark, rows).coalesce(1)).select("lang", "words", "counts").collect()
    got, want = Counter(), Counter()
    for r in found:
        got.update({(r.lang, w): n for w, n in zip(r.words, r.counts, strict=True)})
    for _, t, lang, *_ in rows:
        want.update((lang, w) for w in t.split())
    assert got == want and len(found) > 50


def test_names_shared_by_two_words_give_another_salt(spark, monkeypatch):
    real, salts = collocations._unique, []

    def once(named):
        salts.append(1)
        if len(salts) == 1:
            raise collocations.Clash
        real(named)

    monkeypatch.setattr(collocations, "_unique", once)
    docs = frame(spark, [(k, "one two three", "en", 0, "", 0, 0) for k in range(5)])
    assert {(r.phrase, r.a) for r in collocations.phrases(docs, least=5)[0].collect()} == {("one two three", 5)} and len(salts) > 1
    with pytest.raises(collocations.Clash):
        real(spark.createDataFrame([Row(hi=1, lo=2, phrase="a"), Row(hi=1, lo=2, phrase="b")]))


def test_words_with_marks_behind_are_taken_apart():
    """They are not given to the library whole; the ids are the library's all the same."""
    with open(WORDS, "rb") as f:
        encoder = token_files.Encoder(f.read())
    text, whole, plain = "Ist&&& house$$$ ÉTÉ### x.*** ab<> ab|# don't&& 12%% a<\u0338", [], encoder._plain
    encoder._plain = lambda t: whole.append(t) or plain(t)
    got = np.frombuffer(encoder.ids(text), encoder.kind).tolist()
    assert got == Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    assert whole == ["&&&", "$$$", "###", ".***", "<>", "|#", "don't&&", "12%%", "a<\u0338"]


def test_pre_tokens_of_one_plane_are_the_pattern_s():
    """Every character of the plane alone and among others, and texts beyond it; the regex library is asked for these only."""
    find, want, rnd = alignment._splitter(), regex.compile(alignment._PATTERN).findall, random.Random(3)
    plane = [chr(k) for k in range(0x10000)]
    often = ["", " ", "'s", "'", "\n", "\x1c", "\x85", "\xa0", "\u3000", "a", "É", "1", "٣", "$", "\u0301", "😀", "𝒳"]
    texts = ["".join(plane), " ".join(plane), "a".join(plane), *("".join(rnd.choice(often if rnd.random() < 0.7 else plane) for _ in range(rnd.randrange(20))) for _ in range(5000))]
    assert all(find(t) == want(t) for t in texts)
    asked = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(alignment.regex, "compile", lambda p: SimpleNamespace(findall=lambda t: asked.append(t) or []))
        find = alignment._splitter()
    assert find(texts[1]) == want(texts[1]) and not asked
    assert find("😀") == [] and asked == ["😀"]
