"""The registered queries of the training-data operators, and SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandem.llm import (
    collocations,
    decontaminate,
    fingerprints,
    jaccard,
    pieces,
    records,
    repair,
    secrets,
    simhash,
    suffixes,
    toxicity,
    urls,
    warc,
)

#: Fixed by the query: the rules that pages are judged by.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=13, share=20)


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_bits=2)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.write_and_read(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(read(spark, sf_dir, "documents"), least=50)


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read(spark, sf_dir, "documents"), words=4, percent=85)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), least=10, share=50, first=2000)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(read(spark, sf_dir, "conversations"))


LLM_QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc_archives": op2_warc_archives,
    "op3_toxicity": op3_toxicity,
    "op4_url_filters": op4_url_filters,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_token_records": op8_token_records,
    "op9_secret_scans": op9_secret_scans,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LLM_ORACLES = {
    "op1_benchmark_decontamination": rf"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
            FROM documents),
        item_words AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item,
                   regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item, w[s : s + 12] AS win
            FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM item_words WHERE len(w) > 0)),
        lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
        met AS (
            SELECT d.doc_id, d.s, d.n, x.item
            FROM (SELECT doc_id, n, s, w[s : s + n - 1] AS win
                  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM words, lengths)) d
            JOIN windows x ON x.win = d.win),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM met) GROUP BY 1),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY 1)
        SELECT w.doc_id, len(w.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
               sha256(coalesce(n.items, '')) AS items_sha256,
               coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(w.w) AS contaminated
        FROM words w LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
    """,
    "op2_warc_archives": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        named AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                           THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS kept
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN kept > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN kept > page_id THEN kept END AS refers_to
        FROM named
    """,
    "op4_url_filters": rf"""
        WITH cut AS (
            SELECT page_id,
                   CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
            FROM cut),
        rules(verdict, host, path) AS (VALUES {", ".join(map(str, URL_RULES))}),
        met AS (
            SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
                   row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                                      ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC) AS n
            FROM parts p LEFT JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM met WHERE n = 1
    """,
    "op11_ngram_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
        met AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT u, v FROM met JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
            WHERE 100 * o >= 85 * (x.n + y.n - o)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM words
            UNION
            SELECT r.doc_id, l.there FROM reached r
            JOIN (SELECT u AS here, v AS there FROM links UNION ALL SELECT v, u FROM links) l ON l.here = r.other)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM words w LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) USING (doc_id)
    """,
    "op12_collocations": rf"""
        WITH pieces AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        occurring AS (
            SELECT lang, s.n AS size, unnest(list_transform(range(1, len(w) - s.n + 2), lambda i: array_to_string(w[i : i + s.n - 1], ' '))) AS phrase
            FROM words, (VALUES (1), (2), (3)) s(n) WHERE len(w) >= s.n),
        f AS (SELECT lang, size, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM occurring GROUP BY 1, 2, 3),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY 1),
        cuts AS (
            SELECT c.lang, c.phrase, c.size, c.f AS a, k.k, array_to_string(c.w[1 : k.k], ' ') AS head, array_to_string(c.w[k.k + 1 :], ' ') AS rest
            FROM f c, (VALUES (1), (2)) k(k) WHERE c.size > k.k AND c.f >= 10),
        scored AS (
            SELECT c.*, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.rest),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(f) AS f
            FROM (SELECT lang, f, array_to_string(w[i : i + 1], ' ') AS part FROM f, (VALUES (1), (2)) i(i) WHERE size = 3 AND f >= 10)
            GROUP BY 1, 2)
        SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase, a, l, r, n, score
        FROM lowest c JOIN totals USING (lang) LEFT JOIN longer x ON x.lang = c.lang AND x.part = c.phrase
        WHERE x.f IS NULL OR 100 * x.f < 50 * a
        QUALIFY row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) <= 2000
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(v ORDER BY b) AS t
            FROM (SELECT b, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END, b) AS v
                  FROM (SELECT unnest(range(256)) AS b))),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key
            FROM conversations),
        kinds AS (
            SELECT conv_id, turn, role, text,
                   xor(4294967295, list_reduce(list_transform(key, lambda c: ord(c)::BIGINT),
                       lambda a, b: xor(t[xor(a, b) % 256 + 1], a // 256), 4294967295)) % 20 AS kind
            FROM keyed, crc_table),
        after AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds WHERE kind <> 0),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS k FROM after),
        judged AS (
            SELECT *, left(role, 1) AS initial,
                   NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS seen,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before
            FROM numbered),
        inserts(state, place, paid, letters, added) AS (VALUES
            (0, 0, 0, '', []::VARCHAR[]), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']),
            (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
            (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (2, 2, 4, 'II', ['assistant:', 'user:']),
            (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:']), (3, 3, 4, 'II', ['user:', 'assistant:'])),
        edits(place, letter, initial, goes_to, price, role) AS (
            SELECT place, 'D', NULL::VARCHAR, place, 3, NULL::VARCHAR FROM (VALUES (0), (1), (2), (3)) s(place)
            UNION ALL VALUES (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant'),
                             (3, 'R', NULL, 2, 2, 'user'), (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL),
                             (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL)),
        front AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS k, 0 AS state, {'cost': 0::BIGINT, 'audit': ''} AS best, []::VARCHAR[] AS lines
            FROM conversations
            UNION ALL
            SELECT conv_id, k, state, min(weight), arg_min(lines, weight)
            FROM (SELECT f.conv_id, r.k, e.goes_to AS state,
                         {'cost': f.best.cost + i.paid + e.price + CASE WHEN r.cut AND e.letter <> 'D' THEN 1 ELSE 0 END,
                          'audit': f.best.audit || i.letters || e.letter} AS weight,
                         f.lines || i.added || CASE WHEN e.letter = 'D' THEN []::VARCHAR[]
                                                    ELSE [coalesce(e.role, r.role) || ':' || r.text] END AS lines
                  FROM front f
                  JOIN judged r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.k = f.k + 1
                  JOIN inserts i ON i.state = f.state
                  JOIN edits e ON e.place = i.place AND (e.initial IS NULL OR e.initial = r.initial)
                             AND (e.letter = 'D' OR NOT (r.is_blank OR r.seen)))
            GROUP BY 1, 2, 3),
        counts AS (
            SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (is_blank) AS blank,
                   count(*) FILTER (NOT is_blank AND seen) AS duplicate,
                   count(*) FILTER (NOT is_blank AND NOT seen AND cut) AS truncated,
                   count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
                   count(k) AS n
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
            GROUP BY 1),
        ended AS (
            SELECT c.conv_id, min(weight) AS best, arg_min(lines, weight) AS lines
            FROM (SELECT f.conv_id, {'cost': f.best.cost + i.paid, 'audit': f.best.audit || i.letters} AS weight,
                         f.lines || i.added AS lines, f.k
                  FROM front f JOIN inserts i ON i.state = f.state AND i.place IN (0, 3)) p
            JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.k
            GROUP BY 1)
        SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
               sha256(array_to_string(lines, chr(10))) AS repaired_sha256
        FROM counts c JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
}
