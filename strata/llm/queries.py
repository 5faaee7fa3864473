"""The registered queries of this subpackage, over whole tables."""

import string
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_model
from strata.llm.decontaminate import decontaminate
from strata.llm.embedding_dedup import link_embeddings
from strata.llm.html_extract import extract, fit_extractor
from strata.llm.periodic_runs import periodic_runs
from strata.llm.pieces import encode
from strata.llm.quality import fit_quality, score_quality
from strata.llm.quotes import link_quotes
from strata.llm.shingle_join import shingle_join
from strata.llm.substring_dedup import remove_passages
from strata.llm.token_counts import count_tokens
from strata.llm.toxicity import fit_toxicity, score_toxicity
from strata.llm.whitening import whiten


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words and items of the benchmark found in every document."""
    found = decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, folder, "pages")
    found = extract(pages, fit_extractor(pages), ["page_id", "url"])
    return found.withColumnRenamed("_text", "text").withColumn(
        "n_chars", F.length("text").cast("bigint")
    )


def remainder(name: str, of: int) -> Column:
    """The fold of an id: crc32 of its text; none for a missing id."""
    return F.crc32(F.col(name).cast("string")) % of


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from two folds of three."""
    docs = _table(spark, folder, "documents")
    model = fit_quality(docs, _table(spark, folder, "labels"), remainder("_id", 3) != 1)
    return score_quality(docs, model).select(
        F.col("_id").alias("doc_id"),
        F.coalesce(remainder("_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Every message without quotes, in the order of replies."""
    return link_quotes(_table(spark, folder, "conversations"))


ALPHABETS = (string.ascii_lowercase, string.ascii_uppercase)


def quotation_replies(spark: SparkSession, folder: str) -> DataFrame:
    """The same for conversations in which every message answers the one before: it quotes
    the whole of it, its first line only, or its last line inside another quote."""
    told = _table(spark, folder, "conversations")
    before = told.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.split("text", "\n").alias("quote")
    )
    quote = F.col("quote")
    kind = F.col("turn") % 3
    lines = (
        F.when(kind == 0, F.transform(quote, lambda line: F.concat(F.lit("> "), line)))
        .when(kind == 1, F.array(F.concat(F.lit(">"), F.translate(quote[0], *ALPHABETS))))
        .otherwise(F.array(F.lit("> somebody said"), F.concat(F.lit("> > "), F.element_at(quote, -1))))
    )
    answers = told.join(before, ["conv_id", "turn"], "left").withColumn(
        "text", F.when(quote.isNull(), F.col("text")).otherwise(F.concat_ws("\n", lines, "text"))
    )
    return link_quotes(answers.select(told.columns))


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document, learnt from six folds of seven."""
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    model = language_model.fit(docs.where(~held_out))
    scored = language_model.score(docs, model).withColumnRenamed("_id", "doc_id")
    return scored.withColumn("held_out", held_out)


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies of every vector within its label."""
    return link_embeddings(_table(spark, folder, "embeddings")).withColumnRenamed("_id", "vec_id")


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives its text back."""
    texts = _table(spark, folder, "documents").select("doc_id", "text")
    return encode(texts, verify=True).select(
        "doc_id",
        F.col("_ids").alias("ids"),
        F.size("_ids").cast("bigint").alias("n_tokens"),
        F.col("_exact").alias("round_trip"),
    )


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that repeat earlier ones."""
    return remove_passages(_table(spark, folder, "documents")).select(
        "doc_id",
        "text",
        F.col("_spans").alias("n_passages"),
        F.col("_removed").alias("n_words_removed"),
        (F.col("_removed") > 0).alias("repeats"),
    )


def op9_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies: class and number of links of every document."""
    return shingle_join(_table(spark, folder, "documents")).select(
        "_id", "class_id", "n_links", "kept"
    ).withColumnRenamed("_id", "doc_id")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens and pre-tokens of every document."""
    return count_tokens(_table(spark, folder, "documents")).withColumnRenamed("_id", "doc_id")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from two folds of three."""
    docs = _table(spark, folder, "documents")
    model = fit_toxicity(docs, _table(spark, folder, "labels"), remainder("_id", 3) != 1)
    return score_toxicity(docs, model).select(
        F.col("_id").alias("doc_id"),
        F.coalesce(remainder("_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").cast("bigint").alias("n_passages"),
    )


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector along the first components."""
    return whiten(_table(spark, folder, "embeddings")).withColumnRenamed("_id", "vec_id")


def planted_order(ids: list, sizes: np.ndarray) -> list[np.ndarray | None]:
    """Fixed by the contract: of one id in ten, by crc32, the words from some place on
    repeat some words of it."""
    out: list[np.ndarray | None] = []
    for number, n in zip(ids, sizes.tolist()):
        h = None if number is None else zlib.crc32(str(number).encode())
        if h is None or h % 10 or not n:
            out.append(None)
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places = np.arange(n)
        places[a:] = a + np.arange(n - a) % p
        out.append(places)
    return out


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without them."""
    found = periodic_runs(_table(spark, folder, "documents"), order=planted_order)
    first = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.withColumn("best", first).select(
        F.col("_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality": op3_quality,
    "op4_quotation_linking": op4_quotation_linking,
    "op5_language_model": op5_language_model,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_shingle_join": op9_shingle_join,
    "op10_token_counts": op10_token_counts,
    "op11_toxicity": op11_toxicity,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_periodic_runs": op13_periodic_runs,
    "quotation_replies": quotation_replies,
}

# Fixed: words as the contract of the first query has them.
DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS span
  FROM (SELECT item, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0) x,
       unnest(range(1, len(w) - size + 2)) AS t(s)
), hit AS (
  SELECT r, s, z.size, item
  FROM (SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS span
        FROM d, (SELECT DISTINCT size FROM iw) y, unnest(range(1, len(w) - size + 2)) AS t(s)) z
  JOIN iw ON iw.size = z.size AND iw.span = z.span
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, s, size FROM hit) h, unnest(range(s, s + size)) AS t(p) GROUP BY r
), l AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hit GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r)
"""

QUOTATION_SQL = r"""
WITH RECURSIVE m AS (SELECT *, row_number() OVER () AS r FROM conversations),
s AS (SELECT r, string_split_regex(text, '\r?\n') AS ls FROM m
      WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL),
l AS (SELECT r, i, ls[i] AS line FROM s, unnest(range(1, len(ls) + 1)) AS t(i)),
q AS (SELECT r, i, line ~ '(?s)[ \t]*>.*' AS quote,
        len(regexp_replace(regexp_extract(line, '(?s)^[ \t]*((?:>[ \t]?)+)(.*)$', 1), '[^>]', '', 'g')) AS level,
        CASE WHEN line ~ '(?s)[ \t]*>.*' THEN regexp_extract(line, '(?s)^[ \t]*((?:>[ \t]?)+)(.*)$', 2) ELSE line END AS t
      FROM l),
b AS (SELECT *, trim(t) = '' AS blank, lag(level) OVER w AS before, lag(trim(t) = '') OVER w AS gap
      FROM q WINDOW w AS (PARTITION BY r ORDER BY i)),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> level OR gap OR blank THEN 1 ELSE 0 END)
        OVER (PARTITION BY r ORDER BY i) AS n FROM b),
p AS (SELECT r, n, level, trim(regexp_replace(lower(string_agg(t, chr(10) ORDER BY i)), '[\s\x{a0}]+', ' ', 'g')) AS words
      FROM g WHERE NOT blank GROUP BY r, n, level),
k AS (SELECT p.*, conv_id, turn FROM p JOIN m USING (r) WHERE words <> ''),
o AS (SELECT conv_id, words, min(turn) AS origin FROM k WHERE level = 0 GROUP BY conv_id, words),
f0 AS (SELECT k.r, k.conv_id, k.turn, n, level, CASE WHEN origin < k.turn THEN origin END AS origin
      FROM k LEFT JOIN o ON o.conv_id = k.conv_id AND o.words = k.words WHERE level > 0),
ln AS (SELECT g.r, n, level, conv_id, turn, trim(regexp_replace(lower(t), '[\s\x{a0}]+', ' ', 'g')) AS line
       FROM g JOIN m USING (r) WHERE NOT blank),
lo AS (SELECT conv_id, line, min(turn) AS origin FROM ln WHERE level = 0 AND line <> '' GROUP BY conv_id, line),
lc AS (SELECT ln.r, ln.n, lo.origin, count(*) AS c FROM ln JOIN lo ON lo.conv_id = ln.conv_id AND lo.line = ln.line
       WHERE ln.level > 0 AND lo.origin < ln.turn GROUP BY ln.r, ln.n, lo.origin),
lb AS (SELECT r, n, max({'c': c, 'origin': origin}).origin AS by_lines FROM lc GROUP BY r, n),
f AS (SELECT f0.r, conv_id, turn, f0.n, level, coalesce(origin, by_lines) AS origin
      FROM f0 LEFT JOIN lb ON lb.r = f0.r AND lb.n = f0.n),
a AS (SELECT r, conv_id, turn, count(DISTINCT n) AS n_quotes,
        count(DISTINCT CASE WHEN origin IS NOT NULL THEN n END) AS n_linked,
        max(CASE WHEN origin IS NOT NULL THEN {'near': -level, 'origin': origin} END).origin AS reply_to
      FROM f GROUP BY r, conv_id, turn),
u AS (SELECT conv_id, turn, max(reply_to) AS up FROM a WHERE reply_to IS NOT NULL GROUP BY conv_id, turn),
c(conv_id, turn, top, depth) AS (
  SELECT conv_id, turn, up, 1 FROM u
  UNION ALL SELECT c.conv_id, c.turn, u.up, depth + 1 FROM c JOIN u ON u.conv_id = c.conv_id AND u.turn = c.top),
d AS (SELECT conv_id, turn, min(top) AS thread, max(depth) AS depth FROM c GROUP BY conv_id, turn),
z AS (SELECT m.conv_id, m.turn, m.role,
        CASE WHEN m.text IS NOT NULL THEN regexp_replace(array_to_string(list_filter(
          string_split_regex(m.text, '\r?\n'), lambda x: NOT x ~ '(?s)[ \t]*>.*'), chr(10)), '^\s+|\s+\z', '', 'g') END AS text,
        coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, reply_to,
        coalesce(thread, m.turn) AS thread, CAST(coalesce(d.depth, 0) AS BIGINT) AS depth
      FROM m LEFT JOIN a ON a.r = m.r LEFT JOIN d ON d.conv_id = m.conv_id AND d.turn = m.turn)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread, depth, turn, role, text) - 1 AS position FROM z
"""

# The conversations as the query makes them.
REPLIES_SQL = r"""
SELECT c.conv_id, c.turn, c.role,
       CASE WHEN q IS NULL THEN c.text ELSE concat_ws(chr(10),
         CASE c.turn % 3 WHEN 0 THEN array_to_string(list_transform(q, lambda x: '> ' || x), chr(10))
                         WHEN 1 THEN '>' || translate(q[1], 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')
                         ELSE '> somebody said' || chr(10) || '> > ' || q[-1] END, c.text) END AS text
FROM conversations c LEFT JOIN (SELECT conv_id, turn + 1 AS turn, string_split(text, chr(10)) AS q FROM conversations) b
  ON b.conv_id = c.conv_id AND b.turn = c.turn
"""

ORACLES: dict[str, str] = {
    "quotation_replies": QUOTATION_SQL.replace("FROM conversations)", f"FROM ({REPLIES_SQL}))"),
    "op4_quotation_linking": QUOTATION_SQL,
    "op1_decontamination": DECONTAMINATION_SQL,
}
