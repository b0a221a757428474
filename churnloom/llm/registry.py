"""Registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.llm import chat, decontaminate, html, lines, minhash, mixing, nearest, order, quality, spelling, tokens, topk, whiten
from churnloom.llm.store import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"), matches=False)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.size("hit_words").cast("bigint")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def labelled_for_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without the held-out quarter: ids whose crc32 leaves 2 when divided by 4."""
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, labelled_for_training(spark, sf_dir)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.KEEP_FROM).cast("int").alias("predicted"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.materialise(table(spark, sf_dir, "documents"))


#: one more conversation, whose texts hold control strings
TRAP = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = " UNION ALL ".join(f"SELECT bigint({c}) AS conv_id, bigint({t}) AS turn, '{r}' AS role, '{x}' AS text" for c, t, r, x in TRAP)
    back = chat.read_windows(chat.format_windows(given.union(spark.sql(trap))))
    return back.select(
        "conv_id",
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


#: of all runs, one in so many loses a code point
DROP_EVERY = 199


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), DROP_EVERY))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_near_duplicates,
        op3_quality,
        op4_top_k,
        op5_mixing,
        op6_token_counts,
        op7_training_order,
        op8_chat_windows,
        op9_main_text,
        op10_line_dedup,
        op11_nearest,
        op12_whitening,
        op13_spelling_variants,
    )
}

_DISTINCT_PER_ITEM = """
  SELECT DISTINCT item_id, w[i : i + least(10, len(w)) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bench WHERE len(w) > 0)
"""

ORACLES = {
    "op1_decontaminate": rf"""
WITH bench AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), wins AS ({_DISTINCT_PER_ITEM}
), sizes AS (SELECT DISTINCT len(win) AS n FROM wins
), spots AS (
  SELECT row, n, i, w[i : i + n - 1] AS win FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
), found AS (SELECT row, n, i, item_id FROM spots JOIN wins USING (win)
), hits AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row
), items AS (SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM found GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN items USING (row)
""",
    "op4_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""",
}
