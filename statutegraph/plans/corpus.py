"""Corpus to graph, as a plan of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import vocabulary
from ..operators import articles as art
from ..operators import dedup, graph, parse, references, running
from ..operators.score import Scorer, score
from ..sources import pdf
from ..sources.store import Graph
from ..storage import kept


def records(pieces: DataFrame) -> DataFrame:
    """Entity records from the wording alone: number and title of each article."""
    return pieces.select(
        "doc_id",
        "pos",
        F.coalesce(t.article_number(F.col("article_text")), F.lit(t.UNKNOWN)).alias("article_number"),
        F.coalesce(t.heading_title(F.col("article_text")), F.lit(t.UNKNOWN)).alias("concept"),
        *(F.lit(None).cast("string").alias(c) for c in ("subject", "action", "object")),
        F.col("article_text").alias("full_text"),
    )


def wording(pieces: DataFrame) -> DataFrame:
    """doc_id, pos, article_number, cited, cues: what the wording of each article states, without its text.

    The texts are gone through once, and what was found is written, as edges, their
    articles and what contains them all come from it.
    """
    number = F.coalesce(t.article_number(F.col("article_text")), F.lit(t.UNKNOWN))
    found = pieces.select("doc_id", "pos", number.alias("article_number"), t.citations(F.col("article_text")).alias("cited"), vocabulary.cue_relations(F.col("article_text")).alias("cues"))
    return kept(found, "wording")


def stated(found: DataFrame) -> DataFrame:
    """Triplets of wording(): those of references.citation_triplets() and references.cue_triplets()."""
    cited = F.transform("cited", lambda c: F.struct(F.lit("참조함").alias("relation"), c.alias("cue")))
    rows = found.select("doc_id", "pos", "article_number", F.explode(F.concat(cited, "cues")).alias("c"))
    return rows.select("doc_id", "pos", F.col("article_number").alias("subject"), "c.relation", F.col("c.cue").alias("object"), "article_number", F.lit(1.0).alias("confidence"))


def wording_triplets(pieces: DataFrame) -> DataFrame:
    """Triplets that the wording states: citations and cues."""
    return stated(wording(pieces))


def scored(docs: DataFrame, entity_fn: Scorer, relation_fn: Scorer, partitions: int | None = None, mode: str = "citation") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entity records, triplets and errors from two scorers: records first, then relations with their context.

    An article whose record fails has the default one; what fails at the second
    scorer gives no triplet; both stand in the errors, as does every rejected item.
    Articles, answers and second prompts are written once, as each is read several times.
    """
    pieces = kept(art.articles(docs, mode), "scored-articles").withColumn("prompt", art.entity_prompt(F.col("article_text")))
    answers = score(pieces, "prompt", entity_fn, partitions=partitions, error="error")
    answers = kept(answers.drop("prompt"), "entity-answers")
    entities = parse.entities(answers)
    with_context = art.context(entities)
    asked = kept(with_context.withColumn("prompt", art.relation_prompt(with_context)).select("doc_id", "pos", "prompt"), "relation-prompts")
    relations = score(asked, "prompt", relation_fn, partitions=partitions, error="error")
    failed = answers.filter("error IS NOT NULL").select("doc_id", "pos", F.lit("extract entity").alias("stage"), F.col("error").alias("message"))
    found = parse.errors(relations).withColumn("stage", F.when(F.col("stage") == "extract", "extract relation").otherwise(F.col("stage")))
    return entities, parse.triplets(relations).drop("item_pos"), failed.unionByName(found)


def build(docs: DataFrame, entities: DataFrame | None = None, triplets: DataFrame | None = None, mode: str = "heading", pieces: DataFrame | None = None) -> Graph:
    """The graph of `docs`; without records and triplets those that the wording gives.

    `docs` need a content only where records or triplets come from the wording and
    its articles are not given as `pieces`.
    """
    numbers = entities
    if entities is None or triplets is None:
        pieces = art.articles(docs, mode) if pieces is None else pieces
        found = None if triplets is not None else wording(pieces)
        triplets = stated(found) if triplets is None else triplets
        if entities is None:
            entities = records(pieces)
            numbers = entities if found is None else found  # the same numbers, without the texts
    edges = graph.relation_edges(dedup.dedup_triplets(triplets), numbers)
    return Graph(graph.document_nodes(docs), entities, graph.entities(edges), graph.contains_edges(numbers), edges)


def pdf_documents(meta: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents of a directory's page and metadata tables, content cleaned and rejoined.

    Files that failed are left out; pdf.failures() tells of them.  They load in the
    order of their paths.
    """
    readable = meta.join(pdf.without_text(meta, pages).select("path"), "path", "left_anti")
    docs = pdf.documents(readable, pdf.assemble_pages(pages, readable.select("path")))
    docs = running.numbered(docs.select("path", "title", "law_number", t.rejoin(F.col("content")).alias("content")), "path", "load_seq")
    return docs.select(F.xxhash64("path").alias("doc_id"), "load_seq", "title", "law_number", "content")
