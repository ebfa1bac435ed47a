"""The operators as registered queries, with production parameters, over whole tables; and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.llm import (
    byte_bpe,
    collocations,
    embedding_dedup,
    minhash_dedup,
    mixing,
    packed_tokens,
    pii,
    prefix_trie,
    quality,
    substring_dedup,
    topk_search,
    toxicity,
    url_filter,
)
from spotlift.llm.shared import table


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, folder, "labels")))


def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.fitted(docs, table(spark, folder, "labels")))


def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"))


def op7_packed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return packed_tokens.written_and_read(table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.without_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"), mixing.CORPUS)


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.report(table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_embedding_dedup,
        op2_toxicity,
        op3_minhash_dedup,
        op4_quality,
        op5_topk_search,
        op6_byte_bpe,
        op7_packed_tokens,
        op8_substring_dedup,
        op9_pii,
        op10_mixing,
        op11_url_filter,
        op12_collocations,
        op13_prefix_trie,
        pipeline,
    ]
    return {f.__name__: f for f in named}


_WORDS = r"'[^\x20\x09-\x0D]+'"


def _reach(edges: str) -> str:
    """SQL for ``node, component`` from a frame ``edges`` of links ``a, b`` in both directions."""
    return f"""reach(node, seen) AS (SELECT a, a FROM {edges} UNION SELECT r.node, e.b FROM reach r JOIN {edges} e ON e.a = r.seen),
    parts AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""


def _term(term: str) -> str:
    """SQL for whether a URL term stands alone in ``scanned``."""
    return f"regexp_matches(scanned, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


def _url_sql(policy: url_filter.UrlPolicy) -> str:
    rules = ", ".join("('{}', '{}', '{}')".format(*rule.split("/", 1), verdict) for rule, verdict in policy.rules)
    weights = " + ".join(f"{weight} * {_term(term)}::INT" for term, weight in policy.soft.items())
    strict = " OR ".join(_term(term) for term in policy.strict)
    capitals = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return rf"""WITH rests AS (SELECT row_number() OVER () AS row_no, page_id, regexp_replace(translate(coalesce(url, ''), {capitals}), '%[0-9a-f]{{2}}', ' ', 'g') AS scanned,
        CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS rest FROM pages),
    urls AS (SELECT row_no, page_id, scanned, translate(regexp_extract(rest, '^[^/?#]*'), {capitals}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    rules(host, path, verdict) AS (VALUES {rules}),
    fits AS (SELECT row_no, max_by(r.host || '/' || r.path, length(r.host || '/' || r.path) + length(r.host) / 1e6) AS rule,
        max_by(r.verdict, length(r.host || '/' || r.path) + length(r.host) / 1e6) AS verdict
        FROM urls u JOIN rules r ON ends_with('.' || u.host, '.' || r.host) AND starts_with(u.path, '/' || r.path) GROUP BY row_no)
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {strict} OR {weights} >= {policy.reject_at} THEN 'block' ELSE 'allow' END) AS verdict
    FROM urls LEFT JOIN fits USING (row_no)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_url_filter": _url_sql(url_filter.UrlPolicy()),
        "op12_collocations": rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
        counts AS (SELECT lang, w[i] AS p, 1 AS size, count(*) AS f FROM places GROUP BY ALL
            UNION ALL SELECT lang, array_to_string(w[i:i + 1], ' '), 2, count(*) FROM places WHERE i < len(w) GROUP BY ALL
            UNION ALL SELECT lang, array_to_string(w[i:i + 2], ' '), 3, count(*) FROM places WHERE i + 1 < len(w) GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
        cands AS (SELECT lang, p, size, f AS a, string_split(p, ' ') AS w FROM counts WHERE size > 1 AND f >= 10),
        cuts AS (SELECT lang, p, size, a, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM cands)),
        scores AS (SELECT c.lang, c.p, c.size, c.a, c.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.x AND x.size = c.k JOIN counts y ON y.lang = c.lang AND y.p = c.y AND y.size = c.size - c.k),
        lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        held AS (SELECT lang, inner_p, max(a) AS longer FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_p FROM cands WHERE size = 3) GROUP BY ALL),
        ranked AS (SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, score
            FROM lowest s LEFT JOIN held h ON h.lang = s.lang AND inner_p = p WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
        "op13_prefix_trie": """WITH own AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce("text", '')}
            ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce("text", ''))) AS s
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT c, s, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda crc, byte:
            list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, byte)), 4294967295::BIGINT), 4294967295) % 6 AS h FROM own),
        convs AS (SELECT a.c, list_concat(coalesce(b.s[:a.h], []), a.s[a.h + 1:]) AS s FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 100),
        paths AS (SELECT c, d, len(s) AS n, sha256(s[:d]::VARCHAR) || d AS node, CASE WHEN d > 0 THEN sha256(s[:d - 1]::VARCHAR) || (d - 1) END AS parent,
            CASE WHEN d > 0 THEN length(s[d].t) ELSE 0 END AS points FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM convs)),
        nodes AS (SELECT node, min(c) AS conv_id, d AS depth, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * any_value(points) AS saved,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256 FROM paths GROUP BY node, d),
        kids AS (SELECT parent, count(*) AS k FROM nodes GROUP BY parent),
        totals AS (SELECT p.node, sum(v.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE k IS NULL) AS n_leaves
            FROM nodes v LEFT JOIN kids ON kids.parent = v.node JOIN paths p ON p.c = v.conv_id AND p.d <= v.depth GROUP BY p.node)
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM nodes n LEFT JOIN nodes up ON up.node = n.parent LEFT JOIN kids ON kids.parent = n.node JOIN totals t ON t.node = n.node""",
        "op1_embedding_dedup": f"""WITH RECURSIVE vecs AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
        usable AS (SELECT * FROM vecs WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(v, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        {_reach("links")}
        SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component, e.vec_id) AS component_id, coalesce(component, e.vec_id) = e.vec_id AS kept
        FROM embeddings e LEFT JOIN counts ON a = e.vec_id LEFT JOIN parts ON node = e.vec_id""",
        "op5_topk_search": """WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
        "op3_minhash_dedup": rf"""WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
            FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN
            list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0
            THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        {_reach("links")}
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN parts ON node = d.doc_id""",
        "op8_substring_dedup": rf"""WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50),
        wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM starts),
        firsts AS (SELECT h, min(doc_id) AS first_doc FROM wins GROUP BY h),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM wins JOIN firsts USING (h) WHERE doc_id > first_doc),
        lists AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
        kept AS (SELECT doc_id, len(w) AS n, CASE WHEN g IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END AS k
            FROM words LEFT JOIN lists USING (doc_id))
        SELECT doc_id, n AS n_words, n - len(k) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""",
    }
