"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import bpe, brown, imi, licenses, merkle, minhash, packing, pii, quality, recompress, toxicity, trie, warc
from tradeloom.llm.common import documents


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.Model.fit(docs, toxicity.grades(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.score(docs, model)


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imi.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 100 == 0)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir)).drop("text_hash")


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(documents(spark, sf_dir)).drop("text_hash", "kept_text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), digest_only=True)


def op10_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(documents(spark, sf_dir))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.judged(documents(spark, sf_dir))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_quality, op2_bpe, op3_warc, op4_toxicity, op5_multi_index, op6_pii, op7_minhash, op8_recompression, op9_packing, op10_brown, op11_licenses, op12_trie, op13_merkle)
    return {f.__name__: f for f in found}


_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_KNOWN = licenses.Templates().all
_TEMPLATES = ", ".join(f"({i}, '{t.label}', '{t.family}', {t.kind}, {t.size}, {t.needed})" for i, t in enumerate(_KNOWN))
_TOKENS = ", ".join(f"({i}, '{w.decode()}')" for i, t in enumerate(_KNOWN) for w in sorted(t.words))

_ENCODED = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{0}", "text"))

# crc32 of a number's decimal digits: DuckDB has no such function.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, d: list_reduce([xor(c, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

# The queries whose results follow from their contract alone, without a fitted model, a tokenizer or a search that may miss.
SQL = {
    "op3_warc": """
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
              FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
                    FROM pages))""",
    "op7_minhash": f"""
        WITH RECURSIVE split AS (SELECT doc_id, coalesce({_WORDS.format(_SMALL)}, []) AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x
            FROM split),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (x)
            WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * k >= 75 * (p.n + q.n - k)),
        reached(v, u) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT v, e.b FROM reached JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON e.a = u)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT v AS doc_id, min(u) AS component_id FROM reached GROUP BY 1)
        USING (doc_id)""",
    "op8_recompression": f"""
        WITH split AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split)),
        firsts AS (SELECT x, min(doc_id) AS first FROM windows GROUP BY 1),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (x) WHERE first < doc_id),
        each AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split)),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)""",
    "op11_licenses": f"""
        WITH templates(no, label, family, class, size, needed) AS (VALUES {_TEMPLATES}),
        tokens(no, word) AS (VALUES {_TOKENS}),
        split AS (SELECT doc_id, coalesce(regexp_extract_all({_SMALL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
        each AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM split),
        places AS (
            SELECT doc_id, i, CASE WHEN w[i + 1:i + 4] = ['under', 'the', 'mit', 'license'] THEN 'mit'
                WHEN w[i + 1:i + 4] = ['apache', 'license', 'version', '2'] THEN 'apache-2'
                WHEN w[i + 1:i + 3] = ['cc', 'by', 'nc'] THEN 'cc-by-nc' END AS label
            FROM each),
        base AS (
            SELECT doc_id, count(*) AS n, min(i) AS first, max(i) AS last, list(label) AS labels FROM places
            WHERE label IS NOT NULL GROUP BY 1),
        hits AS (SELECT doc_id, w[i + 1] AS word, i FROM each WHERE w[i + 1] IN (SELECT word FROM tokens)),
        halves AS (SELECT DISTINCT doc_id, word, class, i // class AS b FROM hits CROSS JOIN (SELECT DISTINCT class FROM templates)),
        blocks AS (SELECT * FROM halves UNION SELECT doc_id, word, class, b - 1 FROM halves WHERE b > 0),
        found AS (
            SELECT doc_id, b, t.*, count(*) AS overlap
            FROM blocks JOIN tokens USING (word) JOIN templates t ON t.no = tokens.no AND t.class = blocks.class
            GROUP BY ALL HAVING count(*) >= needed),
        best AS (
            SELECT * FROM (SELECT *, max(overlap) OVER (PARTITION BY doc_id, b, class, family) AS most FROM found) WHERE overlap = most),
        more AS (SELECT doc_id, list(label) AS labels, max(overlap / size) AS score FROM best GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first AS first_word, last AS last_word,
               array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
               CASE WHEN n > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
        FROM split LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)""",
    "op12_trie": f"""
        WITH clean AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        whole AS (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS w
            FROM clean GROUP BY 1),
        heads AS (SELECT *, {_CRC32.format("conv_id")} % 6 AS h FROM whole),
        built AS (
            SELECT c.conv_id, list_concat(coalesce(b.w[1:h], []), c.w[h + 1:]) AS w
            FROM heads c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 100),
        prefixes AS (SELECT conv_id, len(w) AS n, d, w[1:d] AS k FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM built)),
        nodes AS (
            SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN length(k[d].text) ELSE 0 END AS chars,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
            FROM prefixes GROUP BY k, d),
        children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
        own AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
        above AS (SELECT *, k[1:a] AS top FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own)),
        sums AS (
            SELECT top AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
            FROM above GROUP BY 1)
        SELECT own.conv_id, own.d AS depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens,
               sha256(own.ends) AS ends_sha256
        FROM own JOIN sums ON sums.k = own.k LEFT JOIN own p ON own.d > 0 AND p.k = own.k[1:own.d - 1]""",
    "op13_merkle": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, coalesce('1' || lang, '0') AS t, sha256({_ENCODED.format("n_chars")}) AS leaf,
                   CASE WHEN {_CRC32.format("doc_id")} % 7 = 0 THEN sha256({_ENCODED.format("(n_chars + 1)")}) END AS shown
            FROM documents),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n
            FROM leaves),
        nodes(t, l, i, n, h) AS (
            SELECT t, 0, i, n, leaf FROM placed
            UNION ALL
            SELECT t, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY t, l, i // 2, n),
        subroots AS (
            SELECT t, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops(l, i, n, h) AS (
            SELECT 0, i, n, subroot FROM subroots
            UNION ALL
            SELECT l + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY l, i // 2, n),
        walk(t, start, l, i, h, proof) AS (
            SELECT t, i, 0, i, coalesce(shown, leaf), '' FROM placed
            UNION ALL
            SELECT w.t, w.start, w.l + 1, w.i // 2,
                   sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), w.proof || coalesce(s.h, '')
            FROM walk w JOIN nodes o ON o.t = w.t AND o.l = w.l AND o.i = w.i AND o.n > 1
            LEFT JOIN nodes s ON s.t = w.t AND s.l = w.l AND s.i = xor(w.i, 1)),
        climb(t, start, l, i, h, proof) AS (
            SELECT t, start, 0, r.i, h, proof FROM (SELECT *, max(l) OVER (PARTITION BY t) AS top FROM walk) JOIN subroots r USING (t)
            WHERE l = top
            UNION ALL
            SELECT w.t, w.start, w.l + 1, w.i // 2,
                   sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), w.proof || coalesce(s.h, '')
            FROM climb w JOIN tops o ON o.l = w.l AND o.i = w.i AND o.n > 1 LEFT JOIN tops s ON s.l = w.l AND s.i = xor(w.i, 1))
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = root AS verified
        FROM placed p JOIN subroots USING (t) CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
        JOIN (SELECT *, max(l) OVER () AS top FROM climb) c ON c.t = p.t AND c.start = p.i AND c.l = c.top""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
