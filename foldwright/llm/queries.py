"""The operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .decontaminate import find_contaminated
from .lexical import rank_documents
from .main_text import extract_text
from .negatives import mine_negatives
from .packing import pack
from .sentencepieces import decode_pieces, encode_pieces
from .simhash import near_duplicates
from .substring import dedup_substrings
from .token_counts import count_tokens
from .token_files import token_files
from .topk import top_k
from .url_filter import Rule, filter_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


# holds for pages whose main text stands in one article of headings and paragraphs, as in the given tables
MAIN_TEXT_SQL = """
WITH split AS (
    SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS parts
    FROM pages),
plain AS (
    SELECT page_id, url, [trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
        regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) FOR x IN parts] AS blocks
    FROM split),
joined AS (SELECT page_id, url, array_to_string([b FOR b IN blocks IF b <> ''], chr(10) || chr(10)) AS text FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined"""


@query("op2_main_text", MAIN_TEXT_SQL)
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


TOP_K_SQL = """
WITH whole AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op3_top_k_search", TOP_K_SQL)
def top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


URL_RULES = [
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"), Rule("block", "com/de/"),
]
URL_SQL = """
WITH parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
ruled AS (
    SELECT page_id, host, path, CASE
        WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parts)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


@query("op4_url_filter", URL_SQL)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op5_token_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1)


SUBSTRING_SQL = """
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
    SELECT doc_id, i, word, n, i + 12 <= n AS whole,
        string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS span
    FROM placed),
judged AS (
    SELECT doc_id, i, word, whole AND min(CASE WHEN whole THEN doc_id END) OVER (PARTITION BY span, whole) < doc_id AS starts
    FROM windows),
covered AS (
    SELECT doc_id, i, word, max(CAST(starts AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone
    FROM judged),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS text
    FROM covered GROUP BY doc_id)
SELECT s.doc_id, CAST(coalesce(k.n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id"""


@query("op6_substring_dedup", SUBSTRING_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs, words=13).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# every window that shares a shingle with an item of its length, and the multisets compared
DECONTAMINATION_SQL = """
WITH texts AS (SELECT doc_id AS id, text, true AS doc FROM documents UNION ALL SELECT item_id, text, false FROM benchmark),
split AS (
    SELECT id, doc, [w FOR w IN [regexp_replace(lower(t), '[^\\pL\\pN]', '', 'g')
        FOR t IN regexp_extract_all(coalesce(text, ''), '[^\\s\\x{a0}]+')] IF w <> ''] AS words FROM texts),
shingled AS (
    SELECT id, doc, len(words) AS n, unnest(range(0, greatest(len(words) - least(5, len(words)) + 1, 0))) AS i, words FROM split WHERE len(words) > 0),
shingles AS (SELECT id, doc, n, i, array_to_string(words[i + 1:i + least(5, n)], ' ') AS s FROM shingled),
items AS (SELECT id AS item_id, n, s, count(*) AS c FROM shingles WHERE NOT doc GROUP BY ALL),
hits AS (SELECT d.id AS doc_id, d.n AS doc_n, d.i, t.item_id, t.n, d.s, t.c FROM shingles d JOIN items t ON d.s = t.s WHERE d.doc),
starts AS (
    SELECT DISTINCT doc_id, item_id, n, unnest(range(greatest(0, i - n + least(5, n)), least(i, doc_n - n) + 1)) AS first_word FROM hits),
shared AS (
    SELECT w.doc_id, w.item_id, w.n, w.first_word, h.s, least(count(*), any_value(h.c)) AS m
    FROM starts w JOIN hits h ON w.doc_id = h.doc_id AND w.item_id = h.item_id AND h.i BETWEEN w.first_word AND w.first_word + w.n - least(5, w.n)
    GROUP BY w.doc_id, w.item_id, w.n, w.first_word, h.s),
scored AS (
    SELECT doc_id, item_id, n, first_word, CAST(sum(m) AS DOUBLE) / CAST(2 * (n - least(5, n) + 1) - sum(m) AS DOUBLE) AS similarity
    FROM shared GROUP BY doc_id, item_id, n, first_word),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first_word) AS place FROM scored WHERE similarity >= 0.8)
SELECT doc_id, item_id, similarity, CAST(first_word AS BIGINT) AS first_word, CAST(n AS BIGINT) AS n_words FROM ranked WHERE place = 1"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@query("op9_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query("op11_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_BPE)
    decoded = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


HARD_NEGATIVES_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), every=50)


LEXICAL_SQL = """
WITH items AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY ALL),
split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS docs, CAST(sum(len(words)) AS BIGINT) AS terms FROM split),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM split),
postings AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM placed GROUP BY doc_id, term),
weighted AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM postings, total GROUP BY term),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms))))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weighted USING (term), total GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""


@query("op13_lexical_search", LEXICAL_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
