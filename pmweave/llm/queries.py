"""One query per operator over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.llm import alignment, bpe, chat, classifier, collocations, languages, mixing, quality, simhash, tokens, urls, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
MAX_TOKENS = 1024


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p),
     r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM r
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back; a damaged record fails the query instead of going missing."""
    read = warc.read_archives(warc.archive_pages(table(spark, sf_dir, "pages")))
    number = lambda urn: F.expr(f"try_cast(nullif(substr({urn}, 10), '') as bigint)")  # noqa: E731  after urn:page:
    failed = F.raise_error(F.concat_ws(" ", F.lit("damaged record:"), "error", "archive")).cast("string")
    return read.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.when(F.col("error").isNotNull(), failed).otherwise(F.col("record_type")).alias("record_type"), number("refers_to").alias("refers_to"))


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@query(f"""
WITH t AS (SELECT conv_id, coalesce(role, 'unnamed') AS speaker, coalesce(text, '') AS body,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unnamed'), coalesce(text, '')) - 1 AS rank
           FROM conversations),
     p AS (SELECT DISTINCT conv_id, speaker FROM t WHERE speaker <> 'system'),
     v AS (SELECT t.conv_id, p.speaker, rank, rank // {chat.TURNS_PER_PART} AS part, t.speaker = p.speaker AS mine,
                  '<|im_start|>' || CASE WHEN t.speaker = p.speaker THEN 'assistant' WHEN t.speaker = 'system' THEN 'system'
                                         ELSE 'user name=' || t.speaker END || chr(10) AS head,
                  regexp_replace(body, '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g') || '<|im_end|>' AS body
           FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
     s AS (SELECT *, length(head) + coalesce(sum(length(head) + length(body) + 1) OVER (
                  PARTITION BY conv_id, speaker, part ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM v)
SELECT conv_id, speaker, part::BIGINT AS part, count(*)::BIGINT AS n_turns, string_agg(head || body || chr(10), '' ORDER BY rank) AS text,
       coalesce(string_agg(CASE WHEN mine THEN start::BIGINT || '-' || (start + length(body))::BIGINT END, ',' ORDER BY rank), '') AS masks
FROM s GROUP BY conv_id, speaker, part
""")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = chat.rotate(table(spark, sf_dir, "conversations"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return turned.withColumn("masks", masks)


@query()
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled through the document whose number ends their path."""
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)(?:[.][A-Za-z]+)?/?(?:[?#]|$)', 1) as bigint)")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", number.alias("doc_id")).join(labels, "doc_id", "left")
    judged = urls.judge(pages.select("page_id", "url", "label"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query()
def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, md5(text) AS id,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     pos AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
     win AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM pos),
     cov AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM win WHERE n > 1) GROUP BY r),
     ln AS (SELECT r, doc_id, source, id, unnest(string_split(t, chr(10))) AS line FROM d),
     lw AS (SELECT *, lower(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ')) AS norm,
                   len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
     dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY r),
     freq AS (SELECT source, norm, count(DISTINCT coalesce(id, '')) AS holders, min(doc_id) AS keeper FROM lw GROUP BY source, norm),
     over AS (SELECT * FROM freq WHERE holders > {quality.MAX_DOCUMENTS}),
     lost AS (SELECT r, sum(words) AS gone FROM lw JOIN over o ON lw.source IS NOT DISTINCT FROM o.source AND lw.norm = o.norm
              AND lw.doc_id IS DISTINCT FROM o.keeper GROUP BY r),
     base AS (SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                     coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(gone, 0)::BIGINT AS n_removed_words
              FROM d LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
       AND n_removed_words <= {quality.MAX_LOST_SHARE} * n_words AS kept
FROM base
""")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("source", "text_hash")


@query()
def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classifier.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode(docs, ranks, pattern, decoded=True)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query()
def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = languages.held_out(F.col("doc_id"))
    found = languages.identify(docs.select("doc_id", "text"), docs.where(~fold).select("text", "lang"))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.align(table(spark, sf_dir, "documents"), a, b, digest=True)
    return found.select(F.col("id").alias("doc_id"), *alignment.FIGURES, "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query(f"""
WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
     pieces AS (SELECT lang, unnest(string_split_regex(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
     words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
     total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
     runs AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k) WHERE len(w) >= k),
     f AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
     c AS (SELECT * FROM f WHERE k > 1),
     cuts AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM c),
     scored AS (SELECT cuts.lang, cuts.phrase, cuts.k, cuts.a, cut, x.a AS l, y.a AS r, n,
                       (1000::HUGEINT * cuts.a * n) // (x.a::HUGEINT * y.a) AS score
                FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ')
                JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') JOIN total ON total.lang = cuts.lang),
     lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
     kept AS (SELECT * FROM lowest s WHERE NOT EXISTS (
                SELECT 1 FROM c WHERE c.lang = s.lang AND c.k > s.k AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')
                AND 100 * c.a >= {collocations.CONTAINED_PERCENT} * s.a)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {collocations.TOP}
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best(collocations.mine(table(spark, sf_dir, "documents").select("text", "lang")))
