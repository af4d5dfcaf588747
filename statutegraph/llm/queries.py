"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, exact, langid, mixing, pii, pq, sharding, simhash, suffix, trie, urls, warc

#: The surrogates' key; a deployment passes its own, kept apart from the data.
KEY = b"statutegraph-test-key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents"), KEY)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text")
    )
    return chat.digests(chat.format_conversations(rows.unionByName(more)))


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = F.get("positions", 0)
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("positions").alias("copies"), first.alias("first_position"), F.element_at(F.when(first.isNotNull(), F.col("positions")), -1).alias("last_position"))
    return out.repartitionByRange(F.col("first_position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.coded_vectors(table(spark, sf_dir, "embeddings"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (op1_surrogates, op2_warc, op3_hilbert, op4_urls, op5_chat, op6_exact, op7_mixing, op8_decontaminate, op9_langid, op10_simhash, op11_repeats, op12_codes, op13_trie, pipeline)
}

_WORD = r"[^\x20\x09-\x0D]+"

#: Base32 of 40 hexadecimal digits: each five give four letters.
_BASE32 = """array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '')"""

_ESCAPED = r"""replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn>', '<\/turn>')"""


#: CRC-32 of an id's digits: each byte is taken in, then eight steps follow.
_CRC32 = """xor(4294967295, list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, o: CASE WHEN o >= 0 THEN xor(a, o) ELSE xor(a >> 1, (a & 1) * 3988292384) END, 4294967295::BIGINT))"""


def _assigned(r: int) -> str:
    return f"""a{r} AS MATERIALIZED (
            SELECT vec_id, label, part, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, y), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT, 'e': e}}) AS m
            FROM p JOIN b{r} USING (part) GROUP BY vec_id, label, part)"""


def _moved(r: int) -> str:
    return f"""b{r + 1} AS MATERIALIZED (
            SELECT part, e, coalesce(n.y, b{r}.y) AS y FROM b{r} LEFT JOIN (
                SELECT part, e, list(floor(s / c)::BIGINT ORDER BY i) AS y
                FROM (SELECT part, m.e AS e, i, sum(x[i + 1]) AS s, count(*) AS c FROM a{r}, unnest(range(len(x))) u(i) GROUP BY ALL) GROUP BY part, e) n USING (part, e))"""


def _terms(terms: tuple[str, ...]) -> str:
    return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms)


ORACLES = {
    "op2_warc": f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, upper(sha1(coalesce(html, ''))) AS h FROM pages),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS m FROM p)
        SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> m THEN m END AS refers_to, CASE WHEN page_id = m THEN true END AS intact
        FROM g""",
    "op4_urls": rf"""
        WITH p AS (SELECT page_id, coalesce(url, '') AS url,
                          translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
                          translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM pages),
        r AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                             WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                             WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
                     {_terms(urls.STRICT)} AS strict_hits, {_terms(urls.SOFT)} AS soft_hits FROM p)
        SELECT page_id, host, path, rule, strict_hits, soft_hits,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN strict_hits >= 1 OR soft_hits >= {urls.SOFT_NEEDED} THEN 'block' ELSE 'allow' END AS verdict
        FROM r""",
    "op5_chat": rf"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
        g AS (SELECT conv_id, count(*) AS n_turns,
                     string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                     coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                     sum(length('### ' || role || ': ' || {_ESCAPED} || '</turn>') + 1) AS formatted FROM c GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars FROM g""",
    "op6_exact": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op7_mixing": rf"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, md5('mix|' || doc_id) AS draw FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM s)),
        l AS (SELECT *, 3 * source_size AS cap,
                     (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
              FROM w WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, turn, CASE WHEN final IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, final * weight) END AS target
              FROM l, (SELECT max(level) FILTER (cap > level * weight) AS final FROM l)),
        c AS (SELECT d.*, t.source_size, t.target, t.turn, round(t.target)::BIGINT AS due,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE (due // source_size)::BIGINT END AS passes,
                     CASE WHEN size = 0 THEN 0 ELSE greatest(0, least(size, due % source_size - before)) END AS rest,
                     CASE turn WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END AS r0,
                     CASE turn WHEN 0 THEN -1::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 1.6::DOUBLE END AS slope FROM c),
        n AS (SELECT *, (passes + (rest > 0)::INT)::INT AS copies,
                     greatest(0, least(1, before::DOUBLE / target)) AS x0, greatest(0, least(1, (before + (passes + (rest > 0)::INT - 1) * source_size)::DOUBLE / target)) AS x1 FROM k)
        SELECT doc_id, size, source_size, target, (size * passes + rest)::BIGINT AS taken, copies,
               CASE WHEN copies > 0 THEN CASE WHEN x0 <= 0 THEN 0 ELSE least(1, 2 * x0 / (r0 + sqrt(r0 * r0 + 2 * slope * x0))) END END AS first_position,
               CASE WHEN copies > 0 THEN CASE WHEN x1 <= 0 THEN 0 ELSE least(1, 2 * x1 / (r0 + sqrt(r0 * r0 + 2 * slope * x1))) END END AS last_position
        FROM n""",
    "op8_decontaminate": rf"""
        WITH b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM benchmark),
        s AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5)),
        n AS (SELECT item_id, count(*) AS shingles FROM s GROUP BY item_id),
        d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM documents),
        ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
        m AS (SELECT doc_id, item_id, count(*) AS matched FROM ds JOIN s USING (sh) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, matched, shingles, matched::DOUBLE / shingles AS containment FROM m JOIN n USING (item_id) WHERE matched >= 0.8 * shingles""",
    # Texts as hexadecimal digits, in chunks, as a string's end is reached from its beginning.
    "op11_repeats": """
        WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        y AS MATERIALIZED (SELECT doc_id, 1000 * k AS base, substr(x, 2000 * k + 1, 2098) AS y FROM d, unnest(range(len(x) // 2000 + 1)) u(k)),
        w AS MATERIALIZED (SELECT doc_id, base + t AS s, substr(y, 2 * t + 1, 100) AS g FROM y, unnest(range(len(y) // 2 - 49)) u(t)),
        f AS (SELECT g, min(doc_id) AS m FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
        r AS (SELECT doc_id, s, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, -1) AS new FROM w JOIN f USING (g) WHERE m < doc_id),
        i AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r) GROUP BY doc_id, run),
        p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM i),
        q AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS runs, string_agg(substr(x, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
              FROM p JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
        FROM d LEFT JOIN q USING (doc_id)""",
    "op12_codes": f"""
        WITH k AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, len(embedding) // 16 AS w FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT vec_id, label, part, v[part * w + 1:(part + 1) * w] AS x FROM k, range(16) r(part)),
        b0 AS MATERIALIZED (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x AS y FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
        {_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)},
        z AS (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY vec_id, label),
        h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) AS sha FROM b2)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha AS codebooks_sha256 FROM z, h""",
    "op13_trie": f"""
        WITH o AS (SELECT conv_id, list(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s,
                          list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
                   FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        h AS (SELECT *, ({_CRC32} % 6)::INTEGER AS h FROM o),
        b AS MATERIALIZED (SELECT a.conv_id, list_concat(coalesce(o.s[1:h], []), a.s[h + 1:]) AS s, list_concat(coalesce(o.l[1:h], []), a.l[h + 1:]) AS l
                           FROM h a LEFT JOIN o ON o.conv_id = a.conv_id - a.conv_id % 100),
        n AS MATERIALIZED (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(l[d], 0)) AS chars,
                                  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends
                           FROM b, unnest(range(len(s) + 1)) u(d) GROUP BY 1, 2),
        c AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
        m AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (p)),
        t AS (SELECT p[1:k] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens FROM m, unnest(range(d + 1)) u(k) GROUP BY 1)
        SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, sha256(m.ends) AS ends_sha256
        FROM m JOIN t USING (p) LEFT JOIN n up ON m.d > 0 AND up.p = m.p[1:m.d - 1] AND up.d = m.d - 1""",
}
