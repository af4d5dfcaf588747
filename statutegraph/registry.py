"""The registered queries of the library and their SQL."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import text as t
from .functions import vocabulary
from .operators import articles as art
from .operators import dedup, graph, parse, references, running
from .operators.score import score
from .plans import corpus
from .sources import exports, pdf, store
from .storage import kept, new_path
from .streaming import arrivals

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {_VIEWS} {sql}"
        return f

    return add


# Fixed value: the article marker, as functions/text.py has it, in the words of the other engine.
_PAT = r"제\s*\d+\s*조(?:의\s*\d+)?(?:제\s*\d+\s*항)?"
_STRIP = r"'^\s+|\s+$', '', 'g'"
_LABEL = "CASE l_returnflag || l_linestatus " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.LABELS) + " ELSE '참조함' END"
_CITE = "' 제' || (i % 9 + 1) || '조' || CASE WHEN i % 16 = 1 THEN '의2' ELSE '' END || '제' || (i % 4 + 1) || '항' || CASE WHEN i % 3 = 0 THEN '제' || (i % 5 + 1) || '호' ELSE '' END || '에 따라'"
_PLANT = f"CASE i % 8 WHEN 1 THEN {_CITE} " + " ".join(f"WHEN {k} THEN '{w}'" for k, w in fx.PLANTED) + " ELSE '' END"


def _split(c: str, pat: str = _PAT) -> str:
    pieces = rf"list_filter(string_split(regexp_replace({c}, '({pat})', chr(1) || '\1', 'g'), chr(1)), lambda p: regexp_matches(p, '^{pat}'))"
    return f"CASE WHEN regexp_matches({c}, '{pat}') THEN list_transform({pieces}, lambda p: regexp_replace(p, {_STRIP})) ELSE [{c}] END"


_VIEWS = rf"""
ld AS (SELECT doc_id, doc_id AS load_seq, source AS title, '법률 제' || doc_id || '호' AS law_number,
         array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: '제' || i || '조 ' || x), chr(10) || chr(10)) AS content FROM documents),
pieces AS (SELECT doc_id, load_seq, title, i - 1 AS pos, ps[i] AS article_text FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, load_seq, title, {_split('content')} AS ps FROM ld))),
art AS (SELECT doc_id, load_seq, pos, '제' || (pos % 5 + 1) || '조' AS article_number, substring(article_text, 1, 20) AS concept, article_text FROM pieces),
tri AS (SELECT l_orderkey % n AS doc_id,
          row_number() OVER (PARTITION BY l_orderkey % n ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS pos,
          'S' || l_suppkey % 5 AS subject, {_LABEL} AS relation, 'P' || l_partkey % 10 AS object, '제' || l_linenumber || '조' AS article_number,
          round(l_discount::DOUBLE * 10, 1) AS confidence FROM lineitem, (SELECT greatest(1, count(*)) AS n FROM documents)),
ded AS (SELECT doc_id, subject, relation, object, arg_max(article_number, confidence * 10000000 - pos) AS article_number, max(confidence) AS confidence,
          arg_max(pos, confidence * 10000000 - pos) AS pos, min(pos) AS first_pos FROM tri GROUP BY 1, 2, 3, 4),
edges AS (SELECT d.doc_id, d.pos, subject, relation, object, confidence, d.article_number AS article, multiplicity
          FROM ded d JOIN (SELECT doc_id, article_number, count(*) AS multiplicity FROM art GROUP BY 1, 2) USING (doc_id, article_number)),
pl AS (SELECT doc_id, array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: '제' || i || '조(제목' || i || ') ' || x || {_PLANT}), chr(10) || chr(10)) AS content FROM documents),
hp AS (SELECT doc_id, i - 1 AS pos, ps[i] AS article_text FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_split('content', _PAT + '\\s*\\(')} AS ps FROM pl))),
body AS (SELECT doc_id, pos, article_text, regexp_replace(article_text, '^{_PAT}\s*(?:\([^)]*\))?', '') AS rest FROM hp),
types(label, code, category, in_enum, in_prompt) AS (VALUES {", ".join("(" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in r) + ")" for r in vocabulary.RELATIONS)}),
pg AS (SELECT '/' || conv_id || '.pdf' AS path, turn AS page_num, CASE WHEN turn % 3 = 2 THEN ' ' || chr(10) ELSE text END AS text FROM conversations),
joined AS (SELECT path, coalesce(regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY page_num, text) FILTER (regexp_replace(text, {_STRIP}) <> ''), {_STRIP}), '') AS content FROM pg GROUP BY path),
meta AS (SELECT DISTINCT conv_id AS n, '/' || conv_id || '.pdf' AS path, CASE WHEN conv_id % 3 = 0 THEN '제목' || conv_id ELSE '' END AS title,
           CASE WHEN conv_id % 3 = 1 THEN '주제' || conv_id END AS subject, conv_id || '.pdf' AS filename, CASE WHEN conv_id % 11 = 10 THEN 'unreadable' END AS error FROM conversations)
"""

# ---------------------------------------------------------------- text


@query(r"SELECT doc_id, trim(regexp_replace(content, '\s+', ' ', 'g')) AS cleaned FROM ld")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.legal_documents(spark, sf_dir).select("doc_id", t.clean_text(F.col("content")).alias("cleaned"))


@query("SELECT doc_id, pos, article_text FROM pieces")
def split_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.articles(fx.legal_documents(spark, sf_dir))


@query(rf"SELECT doc_id, array_to_string({_split('c')}, chr(10) || chr(10)) AS content FROM (SELECT doc_id, trim(regexp_replace(content, '\s+', ' ', 'g')) AS c FROM ld)")
def rejoin_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.legal_documents(spark, sf_dir).select("doc_id", t.rejoin(F.col("content")).alias("content"))


@query(
    rf"""SELECT m.doc_id, chars, articles, coalesce(e.n, 0) AS entities, coalesce(r.n, 0) AS triplets
    FROM (SELECT doc_id, length(array_to_string(ps, chr(10) || chr(10)))::BIGINT AS chars, len(ps)::BIGINT AS articles FROM (SELECT doc_id, {_split('c')} AS ps FROM (SELECT doc_id, trim(regexp_replace(content, '\s+', ' ', 'g')) AS c FROM ld))) m
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM art GROUP BY 1) e ON m.doc_id = e.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM ded GROUP BY 1) r ON m.doc_id = r.doc_id"""
)
def doc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.with_counts(fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir), dedup.dedup_triplets(fx.triplets(spark, sf_dir)))


@query(
    rf"""SELECT doc_id, pos, n AS article_number, try_cast(regexp_extract(n, '제(\d+)조', 1) AS INTEGER) AS article, try_cast(regexp_extract(n, '조의(\d+)', 1) AS INTEGER) AS branch,
    try_cast(regexp_extract(n, '제(\d+)항', 1) AS INTEGER) AS para FROM (SELECT doc_id, pos, nullif(regexp_replace(regexp_extract(article_text, '^({_PAT})', 1), '\s+', '', 'g'), '') AS n FROM pieces)"""
)
def article_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.numbered(art.articles(fx.legal_documents(spark, sf_dir))).select("doc_id", "pos", "article_number", "parts.article", "parts.branch", "parts.para")


@query(rf"SELECT doc_id, pos, nullif(regexp_extract(article_text, '^{_PAT}\s*\(([^)]*)\)', 1), '') AS title FROM hp")
def heading_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.articles(fx.planted_text(spark, sf_dir), "heading").select("doc_id", "pos", t.heading_title(F.col("article_text")).alias("title"))


@query(
    rf"""SELECT doc_id, pos, start, start + n AS "end" FROM (
      SELECT doc_id, length(ps[i])::BIGINT AS n, i - 1 AS pos, (coalesce(sum(length(ps[i])) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
      FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, list_filter(string_split(regexp_replace(content, '({_PAT})', chr(1) || '\1', 'g'), chr(1)), lambda p: p <> '') AS ps FROM ld)))"""
)
def article_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.offsets(fx.legal_documents(spark, sf_dir))


@query("SELECT doc_id, pos, article_text FROM hp")
def split_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.articles(fx.planted_text(spark, sf_dir), "heading")


@query("SELECT doc_id, pos, article_text FROM pieces WHERE pos < 3")
def first_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.first_articles(art.articles(fx.legal_documents(spark, sf_dir)))


# ---------------------------------------------------------------- order, display


@query(
    """SELECT doc_id, pos, coalesce(nullif(string_agg('- ' || article_number || ': ' || concept, chr(10)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), ''), '없음') AS context FROM art"""
)
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.context(fx.articles(spark, sf_dir)).select("doc_id", "pos", "context")


@query("SELECT doc_id, pos, article_number FROM art WHERE pos < 10")
def first_n_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.first_rows(fx.articles(spark, sf_dir)).select("doc_id", "pos", "article_number")


@query(
    """SELECT doc_id, pos, substring(subject, 1, 20) AS subject, relation, substring(object, 1, 20) AS object, printf('%.2f', confidence) AS confidence
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM tri) WHERE k <= 10"""
)
def display_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.shown_triplets(fx.triplets(spark, sf_dir))


@query(
    """SELECT doc_id, pos, CASE WHEN pos % 4 < 2 THEN article_number ELSE 'Unknown' END AS article_number, CASE WHEN pos % 4 < 2 THEN concept ELSE 'Unknown' END AS concept,
    CASE WHEN pos % 4 < 2 THEN '주체' ELSE '-' END AS subject, '-' AS action FROM art WHERE pos < 10"""
)
def display_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.shown_entities(parse.entities(fx.entity_answers(spark, sf_dir)))


@query("SELECT doc_id, pos, '다음 조문의 번호, 개념, 주체, 행위, 대상을 JSON으로 답하라.' || chr(10) || chr(10) || article_text AS prompt FROM art")
def entity_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.articles(spark, sf_dir).select("doc_id", "pos", art.entity_prompt(F.col("article_text")).alias("prompt"))


@query(
    """SELECT doc_id, pos, '다음 기록의 관계를 JSON 배열로 답하라.' || chr(10) || '조항: ' || article_number || chr(10) || '개념: ' || concept || chr(10) || '주체: N/A' || chr(10) || '행위: N/A' || chr(10)
      || '대상: N/A' || chr(10) || '원문: ' || article_text || chr(10) || '앞 조항: ' ||
      coalesce(nullif(string_agg('- ' || article_number || ': ' || concept, chr(10)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), ''), '없음') AS prompt FROM art"""
)
def relation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = fx.articles(spark, sf_dir).withColumns({"subject": none, "action": F.lit(""), "object": none}).withColumnRenamed("article_text", "full_text")
    rows = art.context(rows)
    return rows.select("doc_id", "pos", art.relation_prompt(rows).alias("prompt"))


# ---------------------------------------------------------------- triplets and graph


@query("SELECT * FROM ded")
def dedup_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_triplets(fx.triplets(spark, sf_dir))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relation_edges(dedup.dedup_triplets(fx.triplets(spark, sf_dir)), fx.articles(spark, sf_dir))


@query("SELECT doc_id, pos FROM art")
def contains_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.contains_edges(fx.articles(spark, sf_dir))


@query("SELECT * FROM edges")
def relation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


@query("SELECT doc_id, pos, subject, relation, object, article_number, confidence FROM ded WHERE NOT EXISTS (SELECT 1 FROM art WHERE art.doc_id = ded.doc_id AND art.article_number = ded.article_number)")
def dropped_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = graph.dropped(dedup.dedup_triplets(fx.triplets(spark, sf_dir)), fx.articles(spark, sf_dir))
    return lost.select("doc_id", "pos", "subject", "relation", "object", "article_number", "confidence")


@query("SELECT subject AS name FROM edges UNION SELECT object FROM edges")
def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.entities(_edges(spark, sf_dir))


@query(
    """SELECT DISTINCT name FROM (SELECT unnest([subject, object]) || '-' || doc_id // 3 AS name FROM edges WHERE doc_id % 4 <> 0)
    WHERE name NOT IN (SELECT unnest([subject, object]) || '-' || doc_id // 3 FROM edges WHERE doc_id % 4 = 0)"""
)
def merge_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of three documents each: those of every fourth document are there, the others arrive."""
    of = F.concat(F.lit("-"), F.floor(F.col("doc_id") / 3))
    edges = _edges(spark, sf_dir).withColumns({c: F.concat(c, of) for c in ("subject", "object")})
    return graph.new_entities(graph.entities(edges.filter("doc_id % 4 <> 0")), graph.entities(edges.filter("doc_id % 4 = 0")))


@query(
    """SELECT k.article_number, doc_id, load_seq, pos, concept FROM (SELECT DISTINCT article_number FROM tri) k
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_number ORDER BY load_seq, pos) AS k FROM art) WHERE k = 1) a ON a.article_number = k.article_number"""
)
def article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.article_lookup(fx.articles(spark, sf_dir).drop("article_text"), fx.triplets(spark, sf_dir).select("article_number"))


@query("SELECT subject, relation, object, confidence FROM edges WHERE article = '제1조'")
def relations_of_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relations_of(_edges(spark, sf_dir), "제1조")


@query("SELECT article, subject, relation, object, confidence FROM edges WHERE article IN (SELECT article_number FROM art WHERE pos = 1)")
def relations_of_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relations_of_many(_edges(spark, sf_dir), fx.articles(spark, sf_dir).filter("pos = 1"))


@query("SELECT art.doc_id, art.load_seq, pos, article_number, concept, title FROM art JOIN ld USING (doc_id)")
def article_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.article_listing(fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir).drop("article_text"))


@query(
    """SELECT e.doc_id, a.pos AS article_pos, article, concept, e.pos, subject, relation, object FROM edges e JOIN art a ON a.doc_id = e.doc_id AND a.article_number = e.article ORDER BY 1, 2, 5 LIMIT 50"""
)
def article_relation_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.article_relations(_edges(spark, sf_dir), fx.articles(spark, sf_dir))


@query("SELECT (SELECT count(*) FROM ld) AS documents, (SELECT count(*) FROM art) AS articles, (SELECT count(*) FROM (SELECT subject FROM edges UNION SELECT object FROM edges)) AS entities")
def graph_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.statistics(fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir), graph.entities(_edges(spark, sf_dir)))


@query("SELECT object AS name, sum(multiplicity)::BIGINT AS refs FROM edges GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.top_entities(_edges(spark, sf_dir))


@query("SELECT category, relation, sum(multiplicity)::BIGINT AS edges, grouping(category, relation)::BIGINT AS level FROM edges LEFT JOIN types ON relation = label GROUP BY ROLLUP (category, relation)")
def relation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relation_rollup(_edges(spark, sf_dir))


@query("SELECT subject, sum(multiplicity)::BIGINT AS edges, count(DISTINCT relation) AS relations FROM edges GROUP BY 1")
def edges_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges_by_subject(_edges(spark, sf_dir))


@query("SELECT subject, relation, object, sum(multiplicity)::BIGINT AS copies FROM edges GROUP BY 1, 2, 3 HAVING sum(multiplicity) > 1")
def duplicate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.duplicate_edges(_edges(spark, sf_dir))


@query("SELECT relation, uses, category, in_enum, in_prompt, coalesce(in_enum OR in_prompt, false) AS known FROM (SELECT relation, count(*) AS uses FROM tri GROUP BY 1) LEFT JOIN types ON relation = label")
def vocab_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.vocabulary_audit(fx.triplets(spark, sf_dir))


@query(
    """SELECT label, CASE WHEN in_enum THEN 'enum' ELSE 'prompt' END AS only_in, coalesce(uses, 0) AS uses FROM types LEFT JOIN (SELECT relation, count(*) AS uses FROM tri GROUP BY 1) ON relation = label WHERE in_enum <> in_prompt"""
)
def vocab_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.vocabulary_difference(fx.triplets(spark, sf_dir))


_COPIES = "cs AS (SELECT a.doc_id, a.pos, a.article_number, a.load_seq, copies FROM art a JOIN (SELECT doc_id, count(*) OVER (PARTITION BY title ORDER BY load_seq) AS copies FROM ld) c ON a.doc_id = c.doc_id)"


def _scope(sql: str) -> str:
    return f"SELECT * FROM (WITH {_COPIES} {sql})"


@query(_scope("SELECT doc_id, pos, article_number, load_seq, copies FROM cs"))
def contains_graph_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.contains_graph_scope(fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir))


@query(
    _scope(
        """SELECT d.doc_id, d.pos, subject, relation, object, confidence, d.article_number AS article, m.multiplicity FROM ded d JOIN (
        SELECT k.doc_id, k.article_number, sum(copies)::BIGINT AS multiplicity FROM (SELECT DISTINCT ded.doc_id, ded.article_number FROM ded JOIN ld USING (doc_id)) k
        JOIN (SELECT article_number, load_seq, sum(copies) AS copies FROM cs GROUP BY 1, 2) c ON c.article_number = k.article_number AND c.load_seq <= k.doc_id GROUP BY 1, 2) m
        ON m.doc_id = d.doc_id AND m.article_number = d.article_number"""
    )
)
def relation_edges_graph_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.relation_edges_graph_scope(fx.legal_documents(spark, sf_dir), dedup.dedup_triplets(fx.triplets(spark, sf_dir)), fx.articles(spark, sf_dir))


def graph_scope_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same edges from three appends in load order, each with the totals of those before it."""
    docs, articles_ = fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir)
    triplets = kept(dedup.dedup_triplets(fx.triplets(spark, sf_dir)), "scope-triplets")
    third = max(1, docs.count() // 3)
    totals = out = None
    for part in (f"doc_id < {third}", f"doc_id BETWEEN {third} AND {2 * third}", f"doc_id > {2 * third}"):
        edges, added = graph.append_graph_scope(docs.filter(part), triplets.filter(part), articles_.filter(part), totals)
        added = kept(added, "scope-totals")
        totals = added if totals is None else totals.unionByName(added)
        out = edges if out is None else out.unionByName(edges)
    return out


QUERIES["graph_scope_appends"], ORACLES["graph_scope_appends"] = graph_scope_appends, ORACLES["relation_edges_graph_scope"]


# ---------------------------------------------------------------- parsing


@query(
    "SELECT doc_id, pos, 0 AS item_pos, subject, relation, object, article_number, CASE WHEN pos % 6 = 3 THEN 1.0 ELSE confidence END AS confidence FROM tri WHERE pos % 6 < 4"
)
def parse_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.triplets(fx.triplet_answers(spark, sf_dir))


@query(
    """SELECT doc_id, pos, CASE WHEN k THEN article_number ELSE 'Unknown' END AS article_number, CASE WHEN k THEN concept ELSE 'Unknown' END AS concept, CASE WHEN k THEN '주체' END AS subject,
    NULL::VARCHAR AS action, NULL::VARCHAR AS object, CASE WHEN k THEN concept ELSE article_text END AS full_text FROM (SELECT *, pos % 4 < 2 AS k FROM art)"""
)
def parse_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.entities(fx.entity_answers(spark, sf_dir))


@query(
    """SELECT doc_id, count(*) AS records, count(*) FILTER (pos % 4 >= 2) AS defaults, count(*) FILTER (pos % 4 >= 2) AS malformed, count(*) FILTER (pos % 4 >= 2) AS no_subject, count(*) AS no_action, count(*) AS no_object FROM art GROUP BY 1"""
)
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.quality(parse.entities(fx.entity_answers(spark, sf_dir)))


@query(
    """SELECT stage, message, count(*) AS errors FROM (
      SELECT 'parse' AS stage, 'no JSON' AS message FROM tri WHERE pos % 6 = 5 UNION ALL SELECT 'validate', 'invalid item' FROM tri WHERE pos % 6 IN (2, 4)
      UNION ALL SELECT 'match', 'no article ' || article_number FROM ded WHERE NOT EXISTS (SELECT 1 FROM art WHERE art.doc_id = ded.doc_id AND art.article_number = ded.article_number)) GROUP BY 1, 2"""
)
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = graph.dropped(dedup.dedup_triplets(fx.triplets(spark, sf_dir)), fx.articles(spark, sf_dir))
    return parse.error_summary(parse.errors(fx.triplet_answers(spark, sf_dir), lost))


# ---------------------------------------------------------------- wording


def _found(c: str, pattern: str, group: int, name: str, source: str = "body") -> str:
    return f"SELECT doc_id, pos, i - 1 AS at, fs[i] AS {name} FROM (SELECT *, unnest(range(1, len(fs) + 1)) AS i FROM (SELECT doc_id, pos, regexp_extract_all({c}, '{pattern}', {group}) AS fs FROM {source}))"


_CITED = _found("rest", _PAT + r"(?:제\s*\d+\s*호)?", 0, "cited")


@query(_CITED)
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.citations(art.articles(fx.planted_text(spark, sf_dir), "heading"))


@query(_found("article_text", "「([^」]+)」", 1, "law"))
def law_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.law_mentions(art.articles(fx.planted_text(spark, sf_dir), "heading"))


@query(_found("article_text", r'["“]([^"”]+)["”]\s*(?:이)?란', 1, "term"))
def defined_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.defined_terms(art.articles(fx.planted_text(spark, sf_dir), "heading"))


@query(
    " UNION ALL ".join(
        rf"SELECT doc_id, pos, n AS subject, '{label}' AS relation, regexp_extract(article_text, '({cue})', 1) AS object, n AS article_number, 1.0::DOUBLE AS confidence FROM (SELECT *, regexp_extract(article_text, '^({_PAT})', 1) AS n FROM hp) WHERE regexp_matches(article_text, '{cue}')"
        for label, cue in vocabulary.CUES
    )
)
def cue_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.cue_triplets(art.articles(fx.planted_text(spark, sf_dir), "heading"))


@query(
    rf"""SELECT DISTINCT cited, CASE WHEN cited LIKE '%호' THEN regexp_replace(cited, '제\d+호$', '') WHEN cited LIKE '%항' THEN regexp_replace(cited, '제\d+항$', '')
    WHEN regexp_matches(cited, '조의\d+$') THEN regexp_replace(cited, '의\d+$', '') END AS parent, nullif(regexp_extract(cited, '^(제\d+조(?:의\d+)?)', 1), cited) AS article FROM ({_CITED})"""
)
def parent_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.parents(references.citations(art.articles(fx.planted_text(spark, sf_dir), "heading")))


@query(
    rf"""SELECT c.doc_id, c.pos, c.at, c.cited, t.target_pos FROM (SELECT *, regexp_extract(cited, '^(제\d+조(?:의\d+)?)', 1) AS target FROM ({_CITED})) c
    LEFT JOIN (SELECT doc_id, regexp_extract(article_text, '^(제\d+조)', 1) AS target, min(pos) AS target_pos FROM hp GROUP BY 1, 2) t ON t.doc_id = c.doc_id AND t.target = c.target"""
)
def citation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.resolve(art.articles(fx.planted_text(spark, sf_dir), "heading"))


@query(
    rf"""SELECT number, CASE WHEN number LIKE '%호' THEN 0 WHEN number LIKE '%항' THEN 1 WHEN regexp_matches(number, '의\d+$') THEN 2 ELSE 3 END AS level, sum(n)::BIGINT AS citations, sum(n) FILTER (number = cited)::BIGINT AS direct
    FROM (SELECT cited, n, unnest(list_distinct([cited, regexp_replace(cited, '제\d+호$', ''), regexp_replace(cited, '(제\d+항)?(제\d+호)?$', ''), regexp_extract(cited, '^제\d+조', 0)])) AS number
          FROM (SELECT cited, count(*) AS n FROM ({_CITED}) GROUP BY 1)) GROUP BY 1"""
)
def citation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of items and paragraphs counted for all that they are part of."""
    out = references.citation_rollup(references.citations(art.articles(fx.planted_text(spark, sf_dir), "heading")))
    return out.withColumn("direct", F.nullif("direct", F.lit(0)))


_CITING = rf"""cs AS (SELECT doc_id, '법률' || doc_id % 7 AS title, array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: '제' || i || '조(제목' || i || ') ' || x ||
    CASE WHEN i % 3 = 1 THEN ' 제1조 및 「' || CASE WHEN i % 5 = 0 THEN '없는 법' ELSE '법률' || (doc_id + i) % 7 END || '」 제' || (i % 9 + 1) || '조제1항, 제 ' || (i % 40 + 1) || ' 조에 따라' ELSE '' END), chr(10) || chr(10)) AS content FROM documents),
cp AS (SELECT doc_id, i - 1 AS pos, ps[i] AS article_text FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_split('content', _PAT + '\\s*\\(')} AS ps FROM cs))),
tk AS (SELECT doc_id, pos, regexp_extract_all(regexp_replace(article_text, '^{_PAT}\s*(?:\([^)]*\))?', ''), '「[^」]+」|{_PAT}(?:제\s*\d+\s*호)?') AS ts FROM cp),
ct AS (SELECT doc_id, pos, len(list_filter(ts[1:i - 1], lambda x: x NOT LIKE '「%')) AS at, trim(list_filter(ts[1:i - 1], lambda x: x LIKE '「%')[-1], '「」') AS law, regexp_replace(ts[i], '\s+', '', 'g') AS cited
       FROM (SELECT *, unnest(range(1, len(ts) + 1)) AS i FROM tk) WHERE ts[i] NOT LIKE '「%')"""


@query(
    rf"""SELECT * FROM (WITH {_CITING}, nm AS (SELECT * FROM ct WHERE law IS NOT NULL),
    av AS (SELECT nm.*, cs.doc_id AS target_doc, regexp_extract(cited, '^(제\d+조(?:의\d+)?)', 1) AS target FROM nm ASOF LEFT JOIN cs ON cs.title = nm.law AND nm.doc_id > cs.doc_id),
    fa AS (SELECT doc_id, regexp_extract(article_text, '^(제\d+조)', 1) AS target, min(pos) AS target_pos FROM cp GROUP BY 1, 2)
    SELECT av.doc_id, av.pos, av.at, av.law, av.cited, target_doc, target_pos, target_pos IS NOT NULL AS resolved FROM av LEFT JOIN fa ON fa.doc_id = target_doc AND fa.target = av.target)"""
)
def cross_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of other statutes, resolved to the version that was loaded last before the citing one."""
    docs = fx.citing_statutes(spark, sf_dir)
    pieces = kept(art.articles(docs, "heading"), "citing-articles")
    return references.across_statutes(references.law_citations(pieces), docs, pieces)


# ---------------------------------------------------------------- sources, sinks, scoring, streams


@query("SELECT path, content FROM joined")
def assemble_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pdf.assemble_pages(fx.pages_of_file(spark, sf_dir))


_MARKED = rf"""mp AS (SELECT '/' || conv_id || '.pdf' AS path, turn AS page_num, CASE turn % 4 WHEN 0 THEN '머리 ' || coalesce(text, '') || ' 제 ' WHEN 1 THEN turn || ' 조 ' || coalesce(text, '') || ' 제' || turn || '조의2 끝 제7'
    WHEN 2 THEN CASE WHEN conv_id % 2 = 0 THEN ' ' || chr(10) ELSE ' 3 ' END ELSE '조(제목) ' || coalesce(text, '') END AS text FROM conversations),
mj AS (SELECT path, coalesce(regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY page_num) FILTER (regexp_replace(text, {_STRIP}) <> ''), {_STRIP}), '') AS content FROM mp GROUP BY path)"""


@query(rf"SELECT * FROM (WITH {_MARKED} SELECT path, i - 1 AS pos, ps[i] AS article_text FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT path, {_split('content')} AS ps FROM mj)))")
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of files found page by page; some markers straddle pages."""
    return pdf.page_articles(fx.marked_pages(spark, sf_dir))


@query("SELECT path, coalesce(nullif(title, ''), nullif(subject, ''), n::VARCHAR) AS title, 'PDF 문서 - ' || filename AS law_number, content FROM meta JOIN joined USING (path) WHERE error IS NULL")
def file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pdf.documents(fx.meta_of_file(spark, sf_dir), pdf.assemble_pages(fx.pages_of_file(spark, sf_dir)))


@query("SELECT path, 'metadata' AS stage, error AS message FROM meta WHERE error IS NOT NULL")
def file_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pdf.failures(fx.meta_of_file(spark, sf_dir))


@query(
    """SELECT path, 'metadata' AS stage, error AS message FROM meta WHERE error IS NOT NULL
    UNION ALL SELECT path, 'text', 'no page could be read' FROM meta WHERE error IS NULL AND n % 13 = 12"""
)
def text_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thirteenth file has no page that could be read."""
    pages = fx.pages_of_file(spark, sf_dir).filter(F.regexp_extract("path", r"(-?\d+)\.pdf$", 1).cast("long") % 13 != 12)
    return pdf.failures(fx.meta_of_file(spark, sf_dir), pages)


@query(
    """SELECT path, CASE WHEN error IS NULL THEN title ELSE '' END AS title, '' AS author, CASE WHEN error IS NULL THEN meta.subject ELSE '' END AS subject, CASE WHEN error IS NULL THEN k ELSE 0 END AS pages, filename, error
    FROM meta JOIN (SELECT '/' || conv_id || '.pdf' AS path, count(*)::INT AS k FROM conversations GROUP BY 1) USING (path)"""
)
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pdf.described(fx.meta_of_file(spark, sf_dir))


@query(
    rf"""SELECT path AS doc_id, length(array_to_string(ps, chr(10) || chr(10)))::BIGINT AS chars, len(ps)::BIGINT AS articles, 0::BIGINT AS entities, 0::BIGINT AS triplets, k AS pages
    FROM (SELECT path, {_split('c')} AS ps FROM (SELECT path, trim(regexp_replace(content, '\s+', ' ', 'g')) AS c FROM joined JOIN meta USING (path) WHERE error IS NULL))
    JOIN (SELECT '/' || conv_id || '.pdf' AS path, count(*)::INT AS k FROM conversations GROUP BY 1) USING (path)"""
)
def file_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of files before extraction: no entities, no triplets, pages as the metadata tells."""
    meta = fx.meta_of_file(spark, sf_dir)
    docs = pdf.documents(meta, pdf.assemble_pages(fx.pages_of_file(spark, sf_dir))).withColumnRenamed("path", "doc_id")
    none = docs.select("doc_id").filter(F.lit(False))
    return art.with_counts(docs, none, none, meta.select(F.col("path").alias("doc_id"), "pages"))


@query("SELECT conv_id || '.' || CASE WHEN conv_id % 2 = 0 THEN 'pdf' ELSE 'PDF' END AS file, sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS length FROM conversations WHERE conv_id % 3 <> 0 GROUP BY conv_id HAVING sum(octet_length(encode(coalesce(text, '')))) > 0")
def list_pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file written for each conversation, a third of them no PDF by name; the others are listed."""
    folder = new_path(spark, "files")
    fx.write_files(spark, sf_dir, folder)
    return pdf.list_files(spark, folder).select(F.substring_index("path", "/", -1).alias("file"), "length")


@query("SELECT title, article_number, concept, NULL::VARCHAR AS subject, NULL::VARCHAR AS action, NULL::VARCHAR AS object, article_text AS full_text FROM art JOIN ld USING (doc_id)")
def article_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV and read again."""
    none = F.lit(None).cast("string")
    listing = graph.article_listing(fx.legal_documents(spark, sf_dir), fx.articles(spark, sf_dir)).withColumns({"subject": none, "action": none, "object": none, "full_text": F.col("article_text")})
    path = new_path(spark, "articles-csv")
    exports.write_articles(listing, path)
    return exports.read_articles(spark, path)


@query("SELECT subject, relation, object FROM edges")
def edge_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as TSV and read again."""
    path = new_path(spark, "edges-tsv")
    exports.write_edges(_edges(spark, sf_dir), path)
    return exports.read_edges(spark, path)


@query(
    """SELECT '법률 ' || conv_id AS title, '제' || turn || '조' AS article_number, coalesce(role, '') || ', "' || turn || '"' AS concept, NULL::VARCHAR AS subject, CASE WHEN turn % 2 = 1 THEN nullif(role, '') END AS action,
    NULL::VARCHAR AS object, nullif(text, '') AS full_text FROM conversations"""
)
def foreign_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing that another program wrote."""
    path = new_path(spark, "foreign-csv")
    fx.write_foreign_listing(spark, sf_dir, path)
    return exports.read_articles(spark, path)


@query(
    rf"""SELECT title, law_number, array_to_string({_split('c')}, chr(10) || chr(10)) AS content, row_number() OVER (ORDER BY encode(path)) AS place
    FROM (SELECT path, coalesce(nullif(title, ''), nullif(subject, ''), n::VARCHAR) AS title, 'PDF 문서 - ' || filename AS law_number, trim(regexp_replace(content, '\s+', ' ', 'g')) AS c FROM meta JOIN joined USING (path) WHERE error IS NULL)"""
)
def pdf_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory's files from pages and metadata to documents, cleaned and split, in the order in which they load."""
    docs = corpus.pdf_documents(fx.meta_of_file(spark, sf_dir), fx.pages_of_file(spark, sf_dir))
    earlier = docs.select("load_seq", F.lit(1).alias("one"))
    place = running.running_sum(earlier.withColumn("all", F.lit(0)), "all", "load_seq", "one", "place").select("load_seq", "place")
    return docs.join(place, "load_seq").select("title", "law_number", "content", "place")


_HALVES = "SELECT (SELECT count(*) FROM ld) AS documents, (SELECT count(*) FROM art) AS articles, (SELECT count(*) FROM (SELECT subject FROM edges UNION SELECT object FROM edges)) AS entities, (SELECT count(*) FROM edges JOIN ld USING (doc_id)) AS relations"


@query("SELECT documents, articles, entities, relations FROM (" + _HALVES + ")")
def append_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents saved, then all of them: those that are there are skipped."""
    path, tables = new_path(spark, "graph"), _to_store(spark, sf_dir)
    for i, own in enumerate(("doc_id % 2 = 0", "true")):
        store.save(corpus.build(*(rows.filter(own) for rows in tables)), path, clear=i == 0)
    saved = store.load(spark, path)
    return graph.statistics(saved.documents, saved.articles, saved.entities, relations=saved.relations)


def _to_store(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Documents (without their content, which no table of a graph has), articles and triplets."""
    docs = fx.legal_documents(spark, sf_dir).select("doc_id", "title", "law_number")
    return [kept(rows, "to-store") for rows in (docs, fx.articles(spark, sf_dir).drop("load_seq"), fx.triplets(spark, sf_dir))]


def _stored(spark: SparkSession, sf_dir: str, saves: int = 3) -> str:
    """The graph of the tables, saved in parts of which each repeats a document of the one before, then merged but for the last."""
    path = new_path(spark, "stored-graph")
    tables = _to_store(spark, sf_dir)
    for i in range(saves):
        part = [rows.filter(f"doc_id % {saves} = {i} OR doc_id = {max(0, i - 1)}") for rows in tables]
        if i == saves - 1:
            store.compact(spark, path, everything=True)
        store.save_batch(corpus.build(*part), path, i)
    return path


@query("SELECT documents, articles, entities, relations, edges FROM (" + _HALVES + "), (SELECT sum(multiplicity)::BIGINT AS edges FROM edges JOIN ld USING (doc_id))")
def stored_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the commits and the sums of the saves; no edge is read."""
    return store.statistics(spark, _stored(spark, sf_dir))


@query("SELECT object AS name, sum(multiplicity)::BIGINT AS refs FROM edges GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def stored_top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.top_entities(spark, _stored(spark, sf_dir))


@query("SELECT subject, sum(multiplicity)::BIGINT AS edges, count(DISTINCT relation) AS relations FROM edges GROUP BY 1")
def stored_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.edges_by_subject(spark, _stored(spark, sf_dir))


@query("SELECT name FROM (SELECT subject AS name FROM edges UNION SELECT object FROM edges)")
def compacted_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities after micro-batches that were merged as they came: each once."""
    path = _stored(spark, sf_dir)
    store.compact(spark, path, everything=True)
    store.vacuum(spark, path, older_than=0)
    return store.load(spark, path).entities


@query(
    """SELECT k.article_number, doc_id, pos, concept FROM (VALUES ('제1조'), ('제4조'), ('제99조')) k(article_number)
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_number ORDER BY doc_id, pos) AS k FROM art) WHERE k = 1) a ON a.article_number = k.article_number"""
)
def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.article_lookup(spark, _stored(spark, sf_dir), ["제1조", "제4조", "제99조"]).select("article_number", "doc_id", "pos", "concept")


@query("SELECT article, subject, relation, object, confidence, multiplicity FROM edges WHERE article IN ('제2조', '제99조')")
def stored_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.relations_of(spark, _stored(spark, sf_dir), ["제2조", "제99조"]).select("article", *graph.EDGE, "confidence", "multiplicity")


def _stub(prompts: pd.Series) -> pd.Series:
    """Stands for a model: answers depend on the prompt alone.

    The stubs are plain loops: prompts also come one by one, where a pandas method costs more than the answer.
    """
    return pd.Series([f'{{"chars": {len(p)}}}' for p in prompts], dtype=object)


@query("SELECT doc_id, pos, '{\"chars\": ' || length(article_text) || '}' AS response FROM art")
def score_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(fx.articles(spark, sf_dir), "article_text", _stub).select("doc_id", "pos", "response")


def _refusing_stub(prompts: pd.Series) -> pd.Series:
    """A model that refuses texts of some lengths, whatever the batch."""
    if any(len(p) % 7 == 3 for p in prompts):
        raise ValueError("refused")
    return _stub(prompts)


@query(
    """SELECT * FROM (WITH p AS (SELECT article_text, bool_or(doc_id % 10 <> 0) AS early, length(any_value(article_text)) % 7 = 3 AS bad FROM art GROUP BY 1)
    SELECT 'first' AS run, count(*) AS asked, count(*) FILTER (bad) AS failed FROM p WHERE early
    UNION ALL SELECT 'second', count(*), count(*) FILTER (bad) FROM p WHERE NOT early OR bad
    UNION ALL SELECT 'third', count(*), count(*) FROM p WHERE NOT early AND bad) WHERE asked > 0"""
)
def rescored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs over a growing corpus ask: what is new, and what failed until it was asked twice."""
    memory, rows = new_path(spark, "answers"), kept(fx.articles(spark, sf_dir).select("doc_id", "article_text"), "rescored-articles")
    for run, part in (("first", rows.filter("doc_id % 10 <> 0")), ("second", rows), ("third", rows), ("fourth", rows)):
        score(part, "article_text", _refusing_stub, memory=memory, attempts=2, run=run)
    return spark.read.parquet(memory).groupBy("run").agg(F.count("*").alias("asked"), F.count_if(F.col("response").isNull()).alias("failed"))


def _entity_stub(prompts: pd.Series) -> pd.Series:
    out = []
    for article in (p.split("\n\n", 1)[1] for p in prompts):
        number = article.split(" ", 1)[0]
        out.append(json.dumps({"article_number": number, "concept": f"c{len(article)}", "full_text": number}, ensure_ascii=False))
    return pd.Series(out, dtype=object)


def _relation_stub(prompts: pd.Series) -> pd.Series:
    out = []
    for p in prompts:
        number, concept = re.search("조항: (.*)", p)[1], re.search("개념: (.*)", p)[1]
        before = len(re.findall(r"(?m)^(?:앞 조항: )?- 제", p))
        out.append(json.dumps([{"subject": number, "relation": "정의함", "object": concept, "article_number": number, "confidence": before}, 1], ensure_ascii=False))
    return pd.Series(out, dtype=object)


@query("SELECT doc_id, pos, n AS subject, '정의함' AS relation, 'c' || length(article_text) AS object, n AS article_number, least(pos, 3)::DOUBLE AS confidence FROM (SELECT *, regexp_extract(article_text, '^(\\S+)', 1) AS n FROM pieces)")
def scored_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from one scorer, then, with their context, triplets from another; confidence counts the context's lines."""
    return corpus.scored(fx.legal_documents(spark, sf_dir), _entity_stub, _relation_stub)[1]


def _failing_stub(prompts: pd.Series) -> pd.Series:
    """A model that refuses texts of some lengths."""
    if any(len(p) % 7 == 3 for p in prompts):
        raise ValueError("refused")
    return _entity_stub(prompts)


@query(
    """SELECT doc_id, pos, 'extract entity' AS stage, 'ValueError: refused' AS message FROM (SELECT *, length('다음 조문의 번호, 개념, 주체, 행위, 대상을 JSON으로 답하라.' || chr(10) || chr(10) || article_text) AS n FROM pieces) WHERE n % 7 = 3
    UNION ALL SELECT doc_id, pos, 'validate', 'invalid item' FROM pieces"""
)
def extraction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two scorers leave as errors: refusals of the first, and from each answer of the second an item that is no triplet."""
    return corpus.scored(fx.legal_documents(spark, sf_dir), _failing_stub, _relation_stub)[2]


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "documents").schema
    # A pattern, as the table may be a file or a folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")


@query("SELECT doc_id, pos, article_text FROM pieces")
def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stream-split")
    arrivals.split_stream(fx.statutes_of(_arriving(spark, sf_dir)), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")


_WORDING = (
    rf"SELECT DISTINCT doc_id, n AS subject, '참조함' AS relation, cited AS object FROM ({_CITED}) JOIN (SELECT doc_id, pos, regexp_extract(article_text, '^({_PAT})', 1) AS n FROM hp) USING (doc_id, pos)"
    + "".join(rf" UNION ALL SELECT DISTINCT doc_id, regexp_extract(article_text, '^({_PAT})', 1), '{label}', regexp_extract(article_text, '({cue})', 1) FROM hp WHERE regexp_matches(article_text, '{cue}')" for label, cue in vocabulary.CUES)
)


@query(f"SELECT * FROM (WITH w AS ({_WORDING}) SELECT (SELECT count(*) FROM ld) AS documents, (SELECT count(*) FROM hp) AS articles, (SELECT count(*) FROM (SELECT subject FROM w UNION SELECT object FROM w)) AS entities, (SELECT count(*) FROM w) AS relations)")
def stream_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted documents arrive and are appended to a graph."""
    path = new_path(spark, "stream-graph")
    titles = {"load_seq": F.col("doc_id"), "title": F.lit(""), "law_number": F.lit("")}
    arrivals.append_stream(fx.planted_of(_arriving(spark, sf_dir)).withColumns(titles), f"{path}/graph", f"{path}/state").awaitTermination()
    saved = store.load(spark, f"{path}/graph")
    return graph.statistics(saved.documents, saved.articles, saved.entities, relations=saved.relations)


@query(f"SELECT d.doc_id, coalesce(a.n, 0) AS articles, coalesce(w.n, 0) AS relations FROM ld d LEFT JOIN (SELECT doc_id, count(*) AS n FROM hp GROUP BY 1) a ON a.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM ({_WORDING}) GROUP BY 1) w ON w.doc_id = d.doc_id")
def concurrent_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams and a batch save into one graph at once, with documents in common; then the first stream runs again from a new checkpoint."""
    path = new_path(spark, "concurrent-graph")
    titles = {"load_seq": F.col("doc_id"), "title": F.lit(""), "law_number": F.lit("")}
    arriving = fx.planted_of(_arriving(spark, sf_dir)).withColumns(titles)

    def stream(keep: str, checkpoint: str):
        return arrivals.append_stream(arriving.filter(keep), f"{path}/graph", f"{path}/{checkpoint}")

    streams = [stream("doc_id % 4 IN (0, 1)", "one"), stream("doc_id % 4 IN (1, 2)", "two")]
    store.save(corpus.build(fx.planted_text(spark, sf_dir).withColumns(titles).filter("doc_id % 4 IN (0, 3)")), f"{path}/graph")
    for running in [*streams, stream("doc_id % 4 IN (0, 1)", "one-again")]:
        running.awaitTermination()
    saved = store.load(spark, f"{path}/graph")
    out = saved.documents.select("doc_id")
    for name in ("articles", "relations"):
        out = out.join(getattr(saved, name).groupBy("doc_id").agg(F.count("*").alias(name)), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


@query(f"SELECT relation, count(*) AS edges FROM ({_WORDING}) GROUP BY 1")
def wording_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plan on planted text: split, records, triplets, deduplication, edges; counted by relation."""
    docs = fx.planted_text(spark, sf_dir).select("doc_id", F.lit("").alias("title"), F.lit("").alias("law_number"), "content")
    return corpus.build(docs).relations.groupBy("relation").agg(F.count("*").alias("edges"))
