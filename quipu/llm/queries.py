"""Contract queries of the subpackage: thin digests of what the operators return."""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import ball_search, fingerprint, group_join, lexical, mixing, packing, pii, prefix_trie, quality, rules, secret_scan, toxicity, warc
from quipu.llm.common import map_batches, small_side, stored, table


def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ["doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans"]
    return pii.digest(pii.find_personal_data(docs)).select(*names)


def tokenizer_path(name: str = packing.TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = packing.pack(packing.pieces(docs, tokenizer_path()))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    files, at = warc.archive(table(spark, folder, "pages"))
    records = warc.read_chunks(files, at, with_data=False).filter("last")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"]
    return rules.vote_quality(docs).select(*names)


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return _judged(quality.score_quality(docs, model), quality.held_out(F.col("doc_id")), "quality", quality.ACCEPT)


def _judged(rows: DataFrame, held_out: Column, score: str, least: float) -> DataFrame:
    predicted = (F.col(score) >= least).cast("int")
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(score).alias("score"), predicted.alias("predicted"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    rows = mixing.repetitions(docs)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ["doc_id", *[f"n_{k}" for k in secret_scan.BASE], "base_sha256", "spans"]
    return secret_scan.digest(secret_scan.scan(docs)).select(*names)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = fingerprint.with_successor(table(spark, folder, "documents").select("doc_id", "text"))

    def compare(texts: list[str], after: list[str]) -> dict:
        changed = [fingerprint.edited(t, f) for t, f in zip(texts, after, strict=True)]
        # The next document mostly is the next row: every text is walked once.
        different = list(dict.fromkeys([*texts, *changed, *after]))
        place, prints = {t: k for k, t in enumerate(different)}, fingerprint.embed_all(different)
        own, other, following = (prints[[place[t] for t in x]] for x in (texts, changed, after))
        return {
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [f.tobytes().hex() for f in own],
            "edited_fingerprint": [f.tobytes().hex() for f in other],
            "near_edited": fingerprint.alike(own, other),
            "near_next": fingerprint.alike(own, following),
        }

    made = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = stored(map_batches(docs, ["text", "following"], ["doc_id"], made, compare), "fingerprints")
    found = fingerprint.partners(rows, rows.filter(F.col("doc_id") % fingerprint.ASK_EVERY == 0))
    found = small_side(stored(found, "fingerprint-partners"))
    return rows.join(found, "fingerprint", "left").select(*rows.columns, F.coalesce("partners", F.lit(0)).alias("partners"))


def op9_group_join(spark: SparkSession, folder: str) -> DataFrame:
    return group_join.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    rows = toxicity.score_texts(docs, model).drop("text")
    return _judged(rows, toxicity.held_out(F.col("doc_id")), "toxicity", toxicity.REJECT)


def op11_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    shards = stored(ball_search.index(vectors), "ball-index")
    return ball_search.top_k(shards, vectors.filter(F.col("vec_id") % ball_search.ASK_EVERY == 0))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data, op2_packing, op3_warc, op4_quality_rules, op5_quality_classifier, op6_mixing, op7_secret_scan, op8_fingerprints, op9_group_join,
        op10_toxicity, op11_top_k, op12_prefix_trie, op13_lexical_search,
    )
}

_OP6 = """
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size,
           md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ticket
    FROM documents
), s AS (
    SELECT source, sum(size) AS source_size,
           CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, 3 * source_size AS top, row_number() OVER o AS place,
           (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0)) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS DOUBLE) AS level
    FROM s
    WINDOW o AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source_size, weight),
           p AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source_size, weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), w AS (
    SELECT min_by(level, place) AS water FROM l WHERE level * weight <= top
), t AS (
    SELECT source, source_size, coalesce(least(CAST(top AS DOUBLE), water * weight), top) AS target FROM l CROSS JOIN w
), n AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN sum(size) OVER (PARTITION BY d.source ORDER BY ticket, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0
                                       <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
"""

_OP3 = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS hexa FROM pages
), d AS (
    SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, list_aggregate(list_transform(range(32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((CAST('0x' || substr(hexa, 5 * CAST(k // 4 AS INTEGER) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)),
        'string_agg', '') AS payload_digest
    FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM f
"""

_OP11 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""

_OP12 = """
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
    SELECT *, (4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(9 * len(CAST(conv_id AS VARCHAR)))), lambda crc, k:
        CASE WHEN k % 9 = 0 THEN xor(crc, CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 9 + 1 AS BIGINT), 1)) AS BIGINT))
             ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 9 AS h
    FROM own
), whole AS (
    SELECT c.conv_id, list_concat(coalesce(list_slice(f.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
    FROM taken c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
    SELECT conv_id, len(turns) = depth AS ends, depth, list_slice(turns, 1, depth) AS prefix
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM whole)
), nodes AS (
    SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
           (count(*) - 1) * coalesce(strlen(any_value(prefix)[-1].text), 0) AS saved
    FROM prefixes GROUP BY prefix
), kids AS (
    SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), family AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (prefix)
), sums AS (
    SELECT list_slice(prefix, 1, up) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM family) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM family n JOIN sums s USING (prefix) LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""

_OP13 = """
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id
), totals AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM counts CROSS JOIN totals GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), impacts AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)) AS x
    FROM counts JOIN sizes USING (doc_id) CROSS JOIN totals
), found AS (
    SELECT item_id, doc_id, CAST(sum(w * x) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL HAVING sum(w * x) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM found QUALIFY rank <= 10
"""

ORACLE_SQL = {"op3_warc": _OP3, "op6_mixing": _OP6, "op11_top_k": _OP11, "op12_prefix_trie": _OP12, "op13_lexical_search": _OP13}
