"""Relations that the wording itself states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocabulary
from ..storage import dealt, kept
from .running import chunk_bounds, running


def citations(pieces: DataFrame) -> DataFrame:
    """doc_id, pos, at, cited: each article cited in an article's body (of heading-mode pieces)."""
    return pieces.select("doc_id", "pos", F.posexplode(t.citations(F.col("article_text"))).alias("at", "cited"))


def law_mentions(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "pos", F.posexplode(t.law_mentions(F.col("article_text"))).alias("at", "law"))


def defined_terms(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "pos", F.posexplode(t.defined_terms(F.col("article_text"))).alias("at", "term"))


def cue_triplets(pieces: DataFrame) -> DataFrame:
    """A triplet for each article and relation whose wording occurs, with confidence 1."""
    number = F.coalesce(t.article_number(F.col("article_text")), F.lit(t.UNKNOWN))
    rows = pieces.select("doc_id", "pos", number.alias("article_number"), F.explode(vocabulary.cue_relations(F.col("article_text"))).alias("c"))
    return rows.select("doc_id", "pos", F.col("article_number").alias("subject"), "c.relation", F.col("c.cue").alias("object"), "article_number", F.lit(1.0).alias("confidence"))


def citation_triplets(pieces: DataFrame) -> DataFrame:
    """Citations as triplets article to cited article."""
    number = F.coalesce(t.article_number(F.col("article_text")), F.lit(t.UNKNOWN))
    cited = pieces.select("doc_id", "pos", number.alias("article_number"), F.explode(t.citations(F.col("article_text"))).alias("object"))
    return cited.select("doc_id", "pos", F.col("article_number").alias("subject"), F.lit("참조함").alias("relation"), "object", "article_number", F.lit(1.0).alias("confidence"))


def parents(cited: DataFrame) -> DataFrame:
    """Distinct citations with their parent, one level up and at the level of the article."""
    rows = cited.select("cited").distinct()
    return rows.select("cited", t.parent_number(F.col("cited")).alias("parent"), t.parent_number(F.col("cited"), "article").alias("article"))


def citation_rollup(cited: DataFrame) -> DataFrame:
    """number, level, citations, direct: how often each number is cited, itself or any part of it.

    level: 3 for an article, 2 for one with a branch, 1 for a paragraph, 0 for an item.
    Citations are counted first, so few rows go up.
    """
    counts = cited.groupBy("cited").agg(F.count("*").alias("n"))
    rows = counts.select(F.posexplode(t.ancestors(F.col("cited"))).alias("up", "number"), "n")
    number = F.col("number")
    level = F.when(number.endswith("호"), 0).when(number.endswith("항"), 1).when(number.rlike(r"의\d+$"), 2).otherwise(3)
    out = rows.groupBy("number").agg(F.sum("n").alias("citations"), F.coalesce(F.sum(F.when(F.col("up") == 0, F.col("n"))), F.lit(0)).alias("direct"))
    return out.select("number", level.alias("level"), "citations", "direct")


def resolved(cited: DataFrame, pieces: DataFrame) -> DataFrame:
    """Citations with `target_pos`, the first article of the document that has the cited number; null if dangling."""
    return _resolved(cited, pieces, None)


def _resolved(cited: DataFrame, pieces: DataFrame, n: int | None) -> DataFrame:
    """resolved(); `n`, if known, bounds how many rows there are of each kind."""
    target = F.regexp_extract("cited", r"(?U)^(제\d+조(?:의\d+)?)", 1)
    numbers = pieces.select("doc_id", F.regexp_extract(F.coalesce(t.article_number(F.col("article_text")), F.lit("")), r"(?U)^(제\d+조(?:의\d+)?)", 1).alias("target"), "pos")
    numbers = numbers.filter("target <> ''")  # no citation is to an article without a number
    asked = cited.withColumn("target", target)
    if n is not None:
        numbers, asked = (dealt(rows, n, "doc_id", "target") for rows in (numbers, asked))
    first = numbers.groupBy("doc_id", "target").agg(F.min("pos").alias("target_pos"))
    return asked.join(first, ["doc_id", "target"], "left").select("doc_id", "pos", "at", "cited", "target_pos")


def resolve(pieces: DataFrame) -> DataFrame:
    """The citations of `pieces`, resolved: the texts are read once, numbers and citations of each article are kept."""
    found = pieces.select("doc_id", "pos", t.article_number(F.col("article_text")).alias("article_text"), t.citations(F.col("article_text")).alias("cited"))
    found = kept(found, "citations")
    sizes = found.agg(F.count("*").alias("articles"), F.coalesce(F.sum(F.size("cited")), F.lit(0)).alias("citations")).first()
    return _resolved(found.select("doc_id", "pos", F.posexplode("cited").alias("at", "cited")), found.drop("cited"), max(sizes))


def law_citations(pieces: DataFrame) -> DataFrame:
    """doc_id, pos, at, law, cited: citations in an article's body with the statute that they name; null where it is their own."""
    found = pieces.select("doc_id", "pos", F.posexplode(t.law_citations(F.col("article_text"))).alias("at", "c"))
    return found.select("doc_id", "pos", "at", "c.law", "c.cited")


def as_of(asked: DataFrame, versions: DataFrame, key: str, order: str, out: str) -> DataFrame:
    """`asked` with the largest order, below its own, of the `versions` with the same key as `out`; null if there is none.

    Orders are integers.  Both sides meet as (key, order) pairs in one running
    maximum, so neither many versions nor many questions of one key land in one task.
    """
    bounds = chunk_bounds(versions, order)
    none = F.lit(None).cast("long")
    pairs = versions.select(key, order, F.col(order).alias("_v")).unionByName(asked.select(key, (F.col(order) - 1).alias(order), none.alias("_v")).distinct())
    last = running(pairs, key, order, "_v", out, bounds, function=F.max).filter(F.col(out).isNotNull())
    return asked.join(last.select(F.col(key).alias("_k"), (F.col(order) + 1).alias("_o"), out), (F.col(key) == F.col("_k")) & (F.col(order) == F.col("_o")), "left").drop("_k", "_o")


def across_statutes(cited: DataFrame, docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """Citations of law_citations() that name a statute, resolved: target_doc, target_pos, and whether they are `resolved`.

    A name means the document of that title that was loaded last before the citing
    one, of several loaded together that of the largest id; target_pos is the first
    article there that has the number.  Null targets are dangling: no such statute
    was there, or it has no such article.
    """
    named = cited.filter(F.col("law").isNotNull()).join(docs.select("doc_id", "load_seq"), "doc_id")
    titles = docs.groupBy(F.col("title").alias("law"), "load_seq").agg(F.max("doc_id").alias("target_doc"))
    asked = as_of(named.select("law", "load_seq").distinct(), titles, "law", "load_seq", "_version")
    known = asked.join(titles.withColumnRenamed("load_seq", "_version"), ["law", "_version"]).select("law", "load_seq", "target_doc")
    placed = named.join(known, ["law", "load_seq"], "left").withColumn("target", F.regexp_extract("cited", r"(?U)^(제\d+조(?:의\d+)?)", 1))
    number = F.regexp_extract(F.coalesce(t.article_number(F.col("article_text")), F.lit("")), r"(?U)^(제\d+조(?:의\d+)?)", 1)
    first = pieces.select(F.col("doc_id").alias("target_doc"), number.alias("target"), "pos").groupBy("target_doc", "target").agg(F.min("pos").alias("target_pos"))
    out = placed.join(first, ["target_doc", "target"], "left")
    return out.select("doc_id", "pos", "at", "law", "cited", "target_doc", "target_pos", F.col("target_pos").isNotNull().alias("resolved"))
