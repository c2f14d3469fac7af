"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leavewatch.llm import chat_format, cover_tree, decontamination, jaccard_join, language_id, line_dedup, packing, spelling, substring_dedup, suffix_dedup, token_output, warc, whitening
from leavewatch.llm.tables import each_row, table
from leavewatch.sources.shared_storage import fresh_path


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_output.write_token_files(table(spark, folder, "documents"), path)
    return token_output.read_token_files(spark, path)


def best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def benchmark_hits(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_pages(spark, path)


def vector_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return cover_tree.top_k(vectors, cover_tree.stated_queries(vectors))


def line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    found = each_row(table(spark, folder, "documents").select("doc_id", "text"), line_dedup.deduplicated)
    return found.select("doc_id", "n_lines", "n_removed", "n_chunks_removed", F.sha2("text", 256).alias("kept_sha256"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.report(table(spark, folder, "documents"))


def word_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = each_row(docs, lambda rows: substring_dedup.deduplicated(rows, digest=True))
    return found.withColumnRenamed("kept", "kept_sha256")


def byte_strings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = each_row(docs, lambda rows: suffix_dedup.deduplicated(rows, digest=True))
    return found.withColumnRenamed("kept", "kept_sha256")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return each_row(docs, jaccard_join.similar, ("doc_id", "class_id", "group_id"))


def chat_turns(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "chats")
    chat_format.formatted(chat_format.with_trial(table(spark, folder, "conversations"))).write.parquet(path)
    return chat_format.digests(chat_format.read_turns(spark.read.parquet(path)))


def whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_chunks,
    "op2_token_files": token_files,
    "op3_jaccard_join": near_duplicates,
    "op4_benchmark_decontamination": benchmark_hits,
    "op5_substring_dedup": word_passages,
    "op6_language_mixture": languages,
    "op7_cover_tree_top_k": vector_top_k,
    "op8_best_fit_packing": best_fit,
    "op9_warc_revisits": warc_revisits,
    "op10_suffix_dedup": byte_strings,
    "op11_chat_formatting": chat_turns,
    "op12_embedding_whitening": whitened_vectors,
    "op13_spelling_variants": spelling_variants,
}
ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": """
        WITH bodies AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS (
            SELECT doc_id, i, ls[i] AS line, len(ls) AS n
            FROM bodies, unnest(range(1, len(ls) + 1)) AS u(i)),
        hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines),
        met AS (
            SELECT *, (coalesce(lag(h) OVER w, 0) * 31 + h) % 4 = 0 AS meets
            FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        marked AS (
            SELECT *, CAST(i = n OR (i > 1 AND i < n - 1 AND meets AND NOT lag(meets) OVER w) AS INTEGER) AS is_end
            FROM met WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        numbered AS (SELECT *, coalesce(sum(is_end) OVER (PARTITION BY doc_id ORDER BY i
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM marked),
        parts AS (SELECT doc_id, no, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS part FROM numbered GROUP BY ALL),
        judged AS (SELECT *, size >= 2 AND row_number() OVER (PARTITION BY size >= 2, part ORDER BY doc_id, no) > 1 AS gone FROM parts)
        SELECT doc_id, CAST(sum(size) AS BIGINT) AS n_lines, CAST(coalesce(sum(size) FILTER (gone), 0) AS BIGINT) AS n_removed,
               count(*) FILTER (gone) AS n_chunks_removed,
               sha256(coalesce(string_agg(part, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op3_jaccard_join": r"""
        WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN ['no words: ' || doc_id] ELSE list_sort(list_distinct(list_transform(
                range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS shingles
            FROM texts),
        classes AS (SELECT shingles, min(doc_id) AS class_id, count(*) AS class_size FROM sets GROUP BY shingles),
        items AS (SELECT class_id, len(shingles) AS size, unnest(shingles) AS shingle FROM classes),
        common AS (
            SELECT a.class_id AS a, b.class_id AS b, a.size AS m, b.size AS n, count(*) AS shared
            FROM items a JOIN items b ON a.shingle = b.shingle AND a.class_id <> b.class_id GROUP BY ALL),
        links AS (SELECT a, b FROM common WHERE shared >= 0.8 * (m + n - shared) - 1e-9),
        reached(class_id, label) AS (
            SELECT class_id, class_id FROM classes
            UNION SELECT r.class_id, l.b FROM reached r JOIN links l ON r.label = l.a),
        grouped AS (SELECT class_id, min(label) AS group_id FROM reached GROUP BY class_id),
        counted AS (SELECT a AS class_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT doc_id, class_id, class_size, coalesce(n_links, 0) AS n_links, group_id
        FROM sets JOIN classes USING (shingles) JOIN grouped USING (class_id) LEFT JOIN counted USING (class_id)""",
    "op4_benchmark_decontamination": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        items AS (
            SELECT row_number() OVER () AS item, item_id, ws, least(len(ws), 10) AS size
            FROM (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
        passages AS (SELECT item, item_id, size, k, array_to_string(ws[k:k + size - 1], ' ') AS passage FROM items, unnest(range(1, len(ws) - size + 2)) AS u(k)),
        places AS (
            SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS passage
            FROM texts, (SELECT DISTINCT size FROM items) AS s, unnest(range(1, len(ws) - size + 2)) AS u(i)),
        found AS (SELECT doc_id, i, size, item, item_id, k FROM places JOIN passages USING (size, passage)),
        covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM found, unnest(range(i, i + size)) AS u(w) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), 'null') AS id FROM found) GROUP BY doc_id),
        numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item, i - k ORDER BY i) AS run FROM found),
        matches AS (
            SELECT doc_id, item_id, min(i) - 1 AS place, max(i) - min(i) + max(size) AS n
            FROM numbered GROUP BY doc_id, item, item_id, i - k, run),
        longest AS (
            SELECT doc_id, first(n ORDER BY n DESC, place, item_id NULLS FIRST) AS n, first(item_id ORDER BY n DESC, place, item_id NULLS FIRST) AS item_id,
                   first(place ORDER BY n DESC, place, item_id NULLS FIRST) AS place
            FROM matches GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated, CAST(n AS INTEGER) AS longest_words, item_id AS longest_item, CAST(place AS INTEGER) AS longest_at
        FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN longest USING (doc_id)""",
    "op5_substring_dedup": r"""
        WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        words AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 12 <= len(ws) THEN array_to_string(ws[i:i + 12], ' ') END AS passage
                  FROM texts, unnest(range(1, len(ws) + 1)) AS u(i)),
        firsts AS (SELECT passage, min(doc_id) AS first_doc FROM words WHERE passage IS NOT NULL GROUP BY passage),
        judged AS (
            SELECT doc_id, i, word, coalesce(bool_or(first_doc < doc_id) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
            FROM words LEFT JOIN firsts USING (passage))
        SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM judged GROUP BY doc_id) USING (doc_id)""",
    "op7_cover_tree_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_warc_revisits": """
        WITH full_pages AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_page FROM full_pages)
        SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN first_page END AS refers_to
        FROM firsts""",
    "op10_suffix_dedup": r"""
        WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        -- Cut first: places of a long string are slow to reach.
        chunks AS (SELECT doc_id, 1000 * k AS base, substr(h, 2000 * k + 1, 2198) AS c FROM texts, unnest(range(0, (strlen(h) // 2 + 999) // 1000)) AS u(k)),
        bytes AS (SELECT doc_id, base + j AS i, substr(c, 2 * j + 1, 2) AS b, CASE WHEN 2 * j + 200 <= strlen(c) THEN md5(substr(c, 2 * j + 1, 200)) END AS piece
                  FROM chunks, unnest(range(0, least(1000, strlen(c) // 2))) AS u(j)),
        firsts AS (SELECT piece, min(CAST(doc_id AS HUGEINT) * 4294967296 + i) AS first_place FROM bytes WHERE piece IS NOT NULL GROUP BY piece HAVING count(*) > 1),
        judged AS (
            SELECT doc_id, i, b, coalesce(bool_or(first_place < CAST(doc_id AS HUGEINT) * 4294967296 + i) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), false) AS gone
            FROM bytes LEFT JOIN firsts USING (piece)),
        edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM judged)
        SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM texts LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept
            FROM edged GROUP BY doc_id) USING (doc_id)""",
    "op11_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)),
        marked AS (
            SELECT *, length(text) + length(text) - length(replace(text, '\', '')) AS text_chars,
                   length(role) + length(role) - length(replace(role, '\', '')) AS role_chars,
                   coalesce(role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), true) AS opens
            FROM turns),
        -- one more sign for each control string
        counted AS (
            SELECT *, text_chars + length(regexp_replace(text, '<(turn|says|part|/turn)>', 'x\0', 'g')) - length(text) AS text_out,
                   role_chars + length(regexp_replace(role, '<(turn|says|part|/turn)>', 'x\0', 'g')) - length(role) AS role_out
            FROM marked)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(text_out + CASE WHEN opens THEN role_out + length('<turn><says></turn>' || chr(10)) ELSE length('<part>') END) AS BIGINT) AS formatted_chars
        FROM counted GROUP BY conv_id""",
    "op13_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc),
        texts AS (
            SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text IS NOT NULL),
        found AS (
            SELECT doc_id, unnest(regexp_extract_all(text, '[a-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM texts),
        runs AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM found GROUP BY ALL),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_transform(range(1, len(bytes), 2), lambda i: CAST('0x' || substr(bytes, i, 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295)) AS h
            FROM runs, crc_table),
        counted AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   CAST(sum(n) AS BIGINT) AS n
            FROM hashed GROUP BY 1),
        words AS (SELECT * FROM counted WHERE length(word) >= 7 AND n >= 2),
        less AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
        judged AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                   CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, form AS reached, 1 AS steps FROM judged WHERE form IS NOT NULL
            UNION ALL SELECT c.word, j.form, steps + 1 FROM chain c JOIN judged j ON c.reached = j.word AND j.form IS NOT NULL),
        ends AS (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM judged LEFT JOIN ends USING (word)""",
}
