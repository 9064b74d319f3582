"""One registered query per training-data operator, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import quality_mil, toxicity
from tagloom.llm.collocations import collocations
from tagloom.llm.common import scratch_path
from tagloom.llm.decontaminate import find_leaks
from tagloom.llm.line_dedup import line_classes
from tagloom.llm.mixing import taken_words
from tagloom.llm.ngram_join import ngram_jaccard_join
from tagloom.llm.quality_mil import held_out
from tagloom.llm.quality_rules import STOP_WORDS, with_quality
from tagloom.llm.sharding import ShardStore
from tagloom.llm.spelling import spelling_variants
from tagloom.llm.token_count import with_token_counts
from tagloom.llm.url_filter import UrlRule, filter_urls
from tagloom.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(f"quality.{f}" for f in fields))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_key")


URL_RULES = [
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled as the document that its url names by number."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    bad = _table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    numbered = pages.withColumn("doc_id", F.try_to_number(F.regexp_extract("url", r"://[^/]*/[a-z]+/(\d+)", 1), F.lit("9" * 18)).cast("long"))
    return filter_urls(pages, numbered.join(bad, "doc_id").select("url", "bad"), URL_RULES)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, bar: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= bar).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return _judged(quality_mil.score_quality(docs, quality_mil.fit(docs, labels)), 0.5)


#: Eighths of the documents that arrive together.
ARRIVALS = (range(5), range(5, 7), range(7, 8))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in three arrivals by a hash of the row; each is compacted."""
    store = ShardStore(spark, scratch_path(spark, "shards"))
    docs = _table(spark, sf_dir, "documents")
    eighth = F.pmod(F.xxhash64("doc_id", "text"), F.lit(8))
    for eighths in ARRIVALS:
        store.append(docs.where(eighth.isin(list(eighths))))
        store.compact_all()
        store.expire()
    return store.read().select("doc_id", "n_chars", "shard", "tier", "shard_rows", "shard_bytes")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return _judged(toxicity.score_toxicity(docs, toxicity.fit(docs, labels)), toxicity.DECISION)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(_table(spark, sf_dir, "documents")).drop("text_key")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), m AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM d
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
        FROM m
    """,
    "op2_quality_rules": r"""
        WITH w AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
            FROM documents
        ), g AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
        ), twice AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(8)) AS k) GROUP BY doc_id
        ), m AS (
            SELECT doc_id, len(ws)::BIGINT AS n_words,
                   coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
                   len(list_filter(ws, lambda x: list_contains({stop}, lower(x)))) AS n_stop
            FROM w LEFT JOIN covered USING (doc_id)
        ), b AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 100 * word_chars < 150 * n_words OR 100 * word_chars > 2000 * n_words
                    OR 100 * n_symbols > 10 * n_words OR 100 * n_stop < n_words OR 100 * n_dup_lines > 50 * n_lines
                    OR 100 * n_words < 200 * n_lines) AS kept
        FROM b
    """.replace("{stop}", str(sorted(set(STOP_WORDS)))),
    "op5_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), g AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS c, md5(string_agg(gram, '|' ORDER BY gram)) AS digest FROM g GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), e AS (
            SELECT x, y, nx.digest AS dx, ny.digest AS dy FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
            WHERE k * 1.8 >= 0.8 * (nx.c + ny.c) - 1e-6
        ), reach(doc_id, r) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x
        ), links AS (
            SELECT x, count(*) AS n_links, count(DISTINCT CASE WHEN dx <> dy THEN dy END) AS n_text_links FROM e GROUP BY x
        )
        SELECT doc_id, min(r) AS class_id, coalesce(any_value(n_links), 0)::BIGINT AS n_links,
               coalesce(any_value(n_text_links), 0)::BIGINT AS n_text_links, coalesce(any_value(c), 0)::INTEGER AS n_grams
        FROM reach LEFT JOIN links ON links.x = reach.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
        ), u AS (
            SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(ws) AS word FROM w) GROUP BY lang, word
        ), t AS (
            SELECT lang, sum(n)::BIGINT AS n FROM u GROUP BY lang
        ), s AS (
            SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w
        ), c AS (
            SELECT lang, phrase, m, count(*) AS a
            FROM (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM s, (SELECT unnest([2, 3, 4]) AS m) WHERE i + m - 1 <= len(ws))
            GROUP BY lang, phrase, m HAVING count(*) >= 30
        ), parts AS (
            SELECT lang, word AS part, n FROM u UNION ALL SELECT lang, phrase, a FROM c
        ), cuts AS (
            SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:m], ' ') AS y
            FROM (SELECT lang, phrase, a, m, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM c)
        ), scores AS (
            SELECT lang, phrase, a, k, l.n AS l, r.n AS r, (2000000::HUGEINT * a) // (l.n + r.n) AS score
            FROM cuts JOIN parts l USING (lang) JOIN parts r USING (lang) WHERE l.part = x AND r.part = y
        ), weakest AS (
            SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, max(a) AS around
            FROM (SELECT lang, a, m, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS i FROM c), (SELECT unnest([2, 3]) AS z)
            WHERE z < m AND i + z - 1 <= m GROUP BY ALL
        ), kept AS (
            SELECT weakest.* FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE coalesce(100 * around < 80 * a, true)
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score::BIGINT AS score
        FROM kept JOIN t USING (lang) QUALIFY rank <= 2000
    """,
}
