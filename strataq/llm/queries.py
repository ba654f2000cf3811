"""The queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, table


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import cut_repeats

    return cut_repeats(table(spark, sf_dir, "documents"), 400, 50).drop("kept")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `key`: rendezvous over 24 equal shards, and over 25."""
    from .sharding import assign_shards, number_slots

    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return number_slots(assign_shards(docs, "doc_id", [1.0] * 24), "doc_id").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 4, 80)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest_columns, personal_data

    return digest_columns(personal_data(table(spark, sf_dir, "documents")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import decide

    found = decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rules")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) == 0)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 4) == 2)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import written
    from .topk import top_k, whole_components

    rows = written(whole_components(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(rows.where(F.col("vec_id") % 100 == 0), rows, 10)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .links import judge

    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import prefix_tree

    return prefix_tree(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_sharding": op2_sharding,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_personal_data": op4_personal_data,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_top_k": op10_top_k,
    "op11_whitening": op11_whitening,
    "op12_url_verdicts": op12_url_verdicts,
    "op13_prefix_tree": op13_prefix_tree,
}

_CRC_STEP = "CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

ORACLES: dict[str, str] = {
    "op2_sharding": f"""
        WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: {_CRC_STEP}) AS c FROM range(256) r(i))),
        d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, coalesce(text, '') AS s FROM documents),
        h AS (SELECT doc_id, k, s, hex(encode(s)) AS x FROM d),
        c AS (SELECT doc_id, k, CAST(strlen(s) + 8 AS BIGINT) AS size,
                CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(s)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
              FROM h, tab),
        u AS (SELECT c.*, list_transform(range(25), lambda s: {{'score': -ln((CAST('0x' || substr(md5(k || ':' || s), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0), 's': s}}) AS a FROM c),
        p AS (SELECT *, CAST(list_min(a[1:24]).s AS INTEGER) AS shard, CAST(list_min(a).s AS INTEGER) AS grown_shard FROM u)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
          row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(k), 1, 8) AS BIGINT), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
        FROM p""",
    "op3_near_duplicates": r"""
        WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS items FROM w),
        c AS (SELECT min(doc_id) AS rep, items, list(doc_id) AS docs FROM s GROUP BY items, CASE WHEN len(items) = 0 THEN doc_id END),
        e AS (SELECT rep, len(items) AS size, unnest(items) AS item FROM c),
        p AS (SELECT a.rep AS a, b.rep AS b, any_value(a.size) AS na, any_value(b.size) AS nb, count(*) AS common FROM e a JOIN e b ON a.item = b.item AND a.rep <> b.rep GROUP BY ALL),
        l AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
        r AS (SELECT rep, rep AS other FROM c UNION SELECT r.rep, l.b FROM r JOIN l ON r.other = l.a),
        m AS (SELECT rep, min(other) AS root FROM r GROUP BY rep),
        d AS (SELECT unnest(docs) AS doc_id, rep, len(items) AS n_shingles FROM c)
        SELECT doc_id, n_shingles, root AS component_id, doc_id = root AS kept FROM d JOIN m USING (rep)""",
    "op8_mixing": r"""
        WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                     CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) AS k FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS w, row_number() OVER (ORDER BY source ASC NULLS LAST) AS n FROM s),
        f AS (SELECT *, row_number() OVER o AS place, sum(source_size) OVER () AS s_all, sum(w) OVER () AS w_all,
                sum(source_size) OVER o - source_size AS s_full, sum(w) OVER o - w AS w_full
              FROM r WINDOW o AS (ORDER BY source_size / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        l AS (SELECT min_by({'place': place, 'level': 150 * s_all - 200 * s_full, 'w': w_all - w_full}, place) AS first FROM f
              WHERE (150 * s_all - 200 * s_full) * w <= 200 * source_size * (w_all - w_full)),
        t AS (SELECT source, source_size, CASE WHEN first IS NULL OR place < first.place THEN CAST(2 * source_size AS DOUBLE)
                ELSE CAST(first.level * w AS DOUBLE) / (100.0::DOUBLE * CAST(first.w AS DOUBLE)) END AS target FROM f, l),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
        b AS (SELECT *, CAST(round(target) AS BIGINT) - epochs * source_size AS budget FROM e),
        i AS (SELECT source, k, doc_id, sum(size) AS total, count(*) AS copies FROM d GROUP BY source, k, doc_id),
        p AS (SELECT *, sum(total) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - total AS prior FROM i)
        SELECT d.doc_id, d.size, b.source_size, b.target,
          CAST(b.epochs * d.size + CASE WHEN p.prior + p.total <= b.budget THEN d.size WHEN p.prior > b.budget THEN 0
            ELSE least(d.size, (b.budget - p.prior) // p.copies) END AS BIGINT) AS taken, d.source
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
          JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.k = p.k AND d.doc_id IS NOT DISTINCT FROM p.doc_id""",
    "op10_top_k": """
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS key, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
        s AS (SELECT q.key, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
              FROM v q JOIN v c ON q.key <> c.key AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY key ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10""",
    "op12_url_verdicts": r"""
        WITH RECURSIVE p AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
        j AS (SELECT *, CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
        said AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said FROM j),
        l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '(?i)href[ \t\n\r]*=[ \t\n\r]*["'']?[ \t\n\r]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'' \t\n\r>]+)', 1),
              lambda h: translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS dst FROM said WHERE host <> ''),
        e AS MATERIALIZED (SELECT src, dst, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY src) AS share FROM l WHERE src <> dst GROUP BY src, dst),
        s AS (SELECT host, CAST(count(*) FILTER (said = 'allow') AS DOUBLE) / count(*) AS trust, CAST(count(*) FILTER (said = 'block') AS DOUBLE) / count(*) AS distrust FROM said WHERE host <> '' GROUP BY host),
        x AS (SELECT 0 AS round, host, trust, distrust FROM s WHERE trust > 0 OR distrust > 0
              UNION ALL SELECT round + 1, CASE side WHEN 1 THEN e.dst ELSE e.src END AS host, sum(CASE side WHEN 1 THEN 0.85 * share * trust ELSE 0 END), sum(CASE side WHEN 2 THEN 0.85 * share * distrust ELSE 0 END)
              FROM x CROSS JOIN (VALUES (1), (2)) AS o(side) JOIN e ON x.host = CASE side WHEN 1 THEN e.src ELSE e.dst END WHERE round < 20 GROUP BY ALL
              HAVING greatest(sum(CASE side WHEN 1 THEN 0.85 * share * trust ELSE 0 END), sum(CASE side WHEN 2 THEN 0.85 * share * distrust ELSE 0 END)) >= 1e-6),
        bad AS (SELECT host AS bad FROM x GROUP BY host HAVING round(sum(distrust), 9) >= 0.5 AND round(sum(distrust), 9) > round(sum(trust), 9))
        SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bad IS NULL THEN 'allow' ELSE 'block' END) AS verdict FROM said LEFT JOIN bad ON host = bad""",
    "op13_prefix_tree": f"""
        WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: {_CRC_STEP}) AS c FROM range(256) r(i))),
        g AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        k AS (SELECT *, substr(sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), 1, 32) AS x, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM g),
        o AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, substr(role, 1, 32), substr(text, 1, 32), x) AS own,
                list(words ORDER BY turn NULLS FIRST, substr(role, 1, 32), substr(text, 1, 32), x) AS words FROM k GROUP BY conv_id),
        c AS (SELECT o.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT))),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h FROM o, tab),
        r AS (SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS s, list_concat(coalesce(b.words[1:c.h], []), c.words[c.h + 1:]) AS w FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
        m AS (SELECT conv_id, s, w, unnest(range(0, len(s) + 1)) AS depth FROM r),
        n AS (SELECT array_to_string(s[1:depth], ',') AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(max(w[depth]), 0) AS saved,
                sha256(coalesce(string_agg(CASE WHEN len(s) = depth THEN conv_id END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM m GROUP BY p, depth),
        ch AS (SELECT left(p, greatest(33 * depth - 34, 0)) AS p, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
        full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (p, depth)),
        up AS (SELECT *, unnest(range(0, depth + 1)) AS lvl FROM full_),
        sub AS (SELECT left(p, greatest(33 * lvl - 1, 0)) AS p, lvl AS depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY ALL)
        SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM full_ f JOIN sub USING (p, depth) LEFT JOIN n q ON q.depth = f.depth - 1 AND q.p = left(f.p, greatest(33 * f.depth - 34, 0))""",
}
