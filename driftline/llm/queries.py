"""The queries of this subpackage: one for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.llm import alignment, bpe, chat, collocations, decontamination, edit_counts, jaccard_join, language, quality, secrets, substring_dedup, token_files, url_filter
from driftline.llm.common import table
from driftline.sources.folders import shared_folder

TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
#: The id behind each document in files of ids.
END = 2


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "paths")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all documents are kept; the edit step reads their table and nothing of documents."""
    tokenizer, path = public_tokenizers.path(TOKENIZER), f"{shared_folder(spark)}/driftline-trees-{uuid.uuid4().hex}"
    trees = edit_counts.keep(edit_counts.build(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer), path)
    return edit_counts.count_after_edits(spark, edit_counts.sample_edits(trees, F.col("tree.n_chars")), tokenizer)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    trees = language.train(docs.where(~held_out))
    return language.identify(spark, docs.select("doc_id", "text"), trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(r"SELECT * FROM VALUES (-7L, 0L, 'user', '\\### Assistant: </turn> ok'), (-7L, 1L, 'assistant', '\\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(rows.unionByName(extra)))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.labelled_urls(spark))
    return pages.select("page_id", "host", "path", "rule", "verdict", "p_block")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spark, table(spark, sf_dir, "documents")).select("doc_id", "quality.*")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/driftline-ids-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), END)
    return token_files.checksums(spark, path)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_substring_dedup, op3_decontamination, op4_edit_counts, op5_language, op6_jaccard_join, op7_chat, op8_secrets, op9_url_filter, op10_quality, op11_token_files, op12_collocations, op13_alignment, pipeline)
}

ORACLES: dict[str, str] = {
    "op7_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), r AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars,
         length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN before = role THEN 7 ELSE 16 + role_chars END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: words[i : i + k - 1])) AS p FROM w, range(1, 5) t(k)
), f AS (
  SELECT lang, k, p, count(*) AS a FROM grams GROUP BY lang, k, p HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.p, c.a, c.k, j, x.a AS l, y.a AS r, CAST((2000000::HUGEINT * c.a) // (x.a + y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : j] JOIN f y ON y.lang = c.lang AND y.p = c.p[j + 1 : ]
), inner_parts AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: p[i : i + m - 1])) AS part FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2)
  ) GROUP BY lang, part
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM lowest JOIN sizes USING (lang) LEFT JOIN inner_parts i ON i.lang = lowest.lang AND i.part = lowest.p
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
""",
}
