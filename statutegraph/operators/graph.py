"""Node and edge tables, lookups and statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary
from ..storage import kept
from .running import chunk_bounds, running_sum

EDGE = ("subject", "relation", "object")


# ---------------------------------------------------------------- nodes and edges


def document_nodes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "title", "law_number", F.localtimestamp().alias("created_at"))


def contains_edges(articles: DataFrame) -> DataFrame:
    """Document to article, by document."""
    return articles.select("doc_id", "pos")


def matched(triplets: DataFrame, articles: DataFrame) -> DataFrame:
    """Triplets with `multiplicity`, the number of articles of their document that have their number.

    Articles are counted first, so nothing fans out; a triplet without one is left out.
    """
    counts = articles.groupBy("doc_id", "article_number").agg(F.count("*").alias("multiplicity"))
    return triplets.join(counts, ["doc_id", "article_number"])


def relation_edges(triplets: DataFrame, articles: DataFrame, expand: bool = False) -> DataFrame:
    """Edges subject to object with relation, confidence and article; one for each match if expanded."""
    edges = matched(triplets, articles).select("doc_id", "pos", *EDGE, "confidence", F.col("article_number").alias("article"), "multiplicity")
    if not expand:
        return edges
    return edges.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("multiplicity")))).drop("multiplicity")


def dropped(triplets: DataFrame, articles: DataFrame) -> DataFrame:
    """Triplets whose number no article of their document has."""
    return triplets.join(articles.select("doc_id", "article_number").distinct(), ["doc_id", "article_number"], "left_anti")


def entities(triplets: DataFrame) -> DataFrame:
    """Distinct names of subjects and objects, in one pass over the triplets."""
    return triplets.select(F.explode(F.array("subject", "object")).alias("name")).distinct()


def new_entities(names: DataFrame, existing: DataFrame) -> DataFrame:
    """Names to create: those of the batch that are not there yet.

    The existing table is first narrowed to the names of the batch, so that it is
    read once and only matches take part in the second join.
    """
    names = names.select("name").distinct()
    there = existing.select("name").join(names, "name", "left_semi").distinct()
    return names.join(there, "name", "left_anti")


# ---------------------------------------------------------------- graph scope


#: The load order of what was there before everything that is given.
_BEFORE = -(1 << 63)


def _earlier(before: DataFrame | None, kind: str, key: str, value: str) -> DataFrame | None:
    if before is None:
        return None
    return before.filter(F.col("kind") == kind).select(F.col("name").alias(key), F.lit(_BEFORE).cast("long").alias("load_seq"), F.col("n").cast("long").alias(value))


def _counted(rows: DataFrame, earlier: DataFrame | None, key: str, value: str, out: str, bounds: list[int]) -> DataFrame:
    """running_sum() over the load order, on top of the totals of the same keys that were there before."""
    if earlier is not None:
        rows = rows.select(key, "load_seq", F.col(value).cast("long").alias(value)).unionByName(earlier.join(rows.select(key).distinct(), key, "left_semi"))
    return running_sum(rows, key, "load_seq", value, out, bounds)


def _copies(docs: DataFrame, bounds: list[int], before: DataFrame | None = None) -> DataFrame:
    """doc_id, load_seq, copies: the documents loaded no later under each one's title."""
    rows = docs.select("title", "load_seq", F.lit(1).alias("_one"))
    counted = _counted(rows, _earlier(before, "title", "title", "_one"), "title", "_one", "copies", bounds)
    return docs.select("doc_id", "title", "load_seq").join(counted, ["title", "load_seq"]).select("doc_id", "load_seq", "copies")


def contains_graph_scope(docs: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles with the copies they get where documents are matched by title alone.

    Titles repeat, and each document loaded no later under the same title takes a
    copy of the article: a running count over the load order, never a join of all
    documents with all.
    """
    of_doc = _copies(docs, chunk_bounds(docs, "load_seq"))
    return articles.drop("load_seq").join(of_doc, "doc_id").select("doc_id", "pos", "article_number", "load_seq", "copies")


def _number_copies(articles: DataFrame, of_doc: DataFrame) -> DataFrame:
    """article_number, load_seq, copies: articles counted by number and document, as often as they are copied."""
    counts = articles.groupBy("doc_id", "article_number").agg(F.count("*").alias("_n"))
    return counts.join(of_doc, "doc_id").select("article_number", "load_seq", (F.col("copies") * F.col("_n")).alias("copies"))


def _scoped_edges(docs: DataFrame, triplets: DataFrame, copies: DataFrame, bounds: list[int], before: DataFrame | None = None) -> DataFrame:
    placed = triplets.join(docs.select("doc_id", "load_seq"), "doc_id")
    asked = placed.select("article_number", "load_seq").distinct().withColumn("copies", F.lit(0).cast("long"))
    sums = _counted(copies.unionByName(asked), _earlier(before, "number", "article_number", "copies"), "article_number", "copies", "multiplicity", bounds)
    return placed.join(sums.filter("multiplicity > 0"), ["article_number", "load_seq"]).select("doc_id", "pos", *EDGE, "confidence", F.col("article_number").alias("article"), "multiplicity")


def relation_edges_graph_scope(docs: DataFrame, triplets: DataFrame, articles: DataFrame) -> DataFrame:
    """Triplets with `multiplicity`: the articles of their number in all documents loaded no later.

    Articles count as often as contains_graph_scope() copies them.  Articles and
    triplets are counted by number and document first; only these counts go
    through the running sum.  Triplets and what is needed of documents are written
    once, as each is read several times.
    """
    docs, triplets = kept(docs.select("doc_id", "title", "load_seq"), "scope-documents"), kept(triplets, "scope-triplets")
    bounds = chunk_bounds(docs, "load_seq")
    return _scoped_edges(docs, triplets, _number_copies(articles, _copies(docs, bounds)), bounds)


def append_graph_scope(docs: DataFrame, triplets: DataFrame, articles: DataFrame, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """relation_edges_graph_scope() of documents that come after others, and the totals to keep for the next ones.

    `before`: kind (title or number), name, n, all totals that earlier appends gave;
    they stand for all documents before, of which no row is read.  The new totals
    are those of these documents alone, to be put beside the earlier ones.
    """
    bounds = chunk_bounds(docs, "load_seq")
    of_doc = kept(_copies(docs, bounds, before), "document-copies")
    copies = kept(_number_copies(articles, of_doc), "number-copies")
    titles = docs.groupBy(F.lit("title").alias("kind"), F.col("title").alias("name")).agg(F.count("*").alias("n"))
    numbers = copies.groupBy(F.lit("number").alias("kind"), F.col("article_number").alias("name")).agg(F.sum("copies").alias("n"))
    return _scoped_edges(docs, triplets, copies, bounds, before), titles.unionByName(numbers)


# ---------------------------------------------------------------- lookups


def article_lookup(articles: DataFrame, keys: DataFrame, order: tuple[str, ...] = ("load_seq", "pos")) -> DataFrame:
    """For each of the numbers in `keys` the first article that has it, by load order and position; nulls if none.

    The first is found by a partial aggregate over the articles.
    """
    rest = F.struct(*[c for c in articles.columns if c != "article_number"])
    first = articles.join(keys.distinct(), "article_number", "left_semi").groupBy("article_number").agg(F.min_by(rest, F.struct(*order)).alias("a"))
    return keys.distinct().join(first, "article_number", "left").select("article_number", "a.*")


def relations_of(edges: DataFrame, number: str) -> DataFrame:
    """Edges that came from an article number; the filter reaches the scan."""
    return edges.filter(F.col("article") == number).select(*EDGE, "confidence")


#: Keys that are sent to all machines, at most.
BROADCAST_KEYS = 200_000


def relations_of_many(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """As relations_of(), for a table of numbers.

    The numbers go to the edges, which stay where they are, so a number that stands in
    every statute fills no task; only beyond BROADCAST_KEYS numbers both sides meet by shuffle.
    """
    numbers = kept(keys.select(F.col("article_number").alias("article")).distinct(), "asked-numbers")
    few = numbers.count() <= BROADCAST_KEYS
    return edges.join(F.broadcast(numbers) if few else numbers, "article").select("article", *EDGE, "confidence")


def article_listing(docs: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles with the title of their document."""
    return articles.join(docs.select("doc_id", "title"), "doc_id")


def article_relations(edges: DataFrame, articles: DataFrame, n: int = 50) -> DataFrame:
    """The first `n` rows of article, relation and entities, in document order."""
    numbered = articles.select("doc_id", F.col("article_number").alias("article"), F.col("pos").alias("article_pos"), "concept")
    rows = edges.join(numbered, ["doc_id", "article"]).select("doc_id", "article_pos", "article", "concept", "pos", *EDGE)
    return rows.orderBy("doc_id", "article_pos", "pos").limit(n)


# ---------------------------------------------------------------- statistics


def statistics(docs: DataFrame, articles: DataFrame, names: DataFrame, **more: DataFrame) -> DataFrame:
    """One row: documents, articles, entities, and what else is named; zeros for an empty graph."""
    tables = {"documents": docs, "articles": articles, "entities": names} | more
    every = reduce(DataFrame.unionByName, (rows.select(F.lit(label).alias("label")) for label, rows in tables.items()))
    return every.agg(*(F.count_if(F.col("label") == label).alias(label) for label in tables))


def top_entities(edges: DataFrame, n: int = 10) -> DataFrame:
    """Entities by incoming edges, ties by name."""
    return edges.groupBy(F.col("object").alias("name")).agg(F.sum("multiplicity").alias("refs")).orderBy(F.desc("refs"), "name").limit(n)


def relation_rollup(edges: DataFrame) -> DataFrame:
    """Edges by category and relation, with subtotals and a total."""
    types = F.broadcast(vocabulary.relation_types(edges.sparkSession).select(F.col("label").alias("relation"), "category"))
    return edges.join(types, "relation", "left").rollup("category", "relation").agg(F.sum("multiplicity").alias("edges"), F.grouping_id().alias("level"))


def edges_by_subject(edges: DataFrame) -> DataFrame:
    return edges.groupBy("subject").agg(F.sum("multiplicity").alias("edges"), F.count_distinct("relation").alias("relations"))


def duplicate_edges(edges: DataFrame) -> DataFrame:
    """Edges that stand more than once in the graph, with how often."""
    return edges.groupBy(*EDGE).agg(F.sum("multiplicity").alias("copies")).filter("copies > 1")


def vocabulary_audit(triplets: DataFrame) -> DataFrame:
    """Every relation that occurs, with what the vocabulary says of it; `known` is false outside of it."""
    types = F.broadcast(vocabulary.relation_types(triplets.sparkSession).withColumnRenamed("label", "relation"))
    used = triplets.groupBy("relation").agg(F.count("*").alias("uses"))
    known = F.coalesce(F.col("in_enum") | F.col("in_prompt"), F.lit(False))
    return used.join(types, "relation", "left").select("relation", "uses", "category", "in_enum", "in_prompt", known.alias("known"))


def vocabulary_difference(triplets: DataFrame) -> DataFrame:
    """Labels that only one of the two vocabularies has, with how many triplets use them."""
    types = vocabulary.relation_types(triplets.sparkSession)
    listed, asked = types.filter("in_enum").select("label"), types.filter("in_prompt").select("label")
    only = listed.exceptAll(asked).withColumn("only_in", F.lit("enum")).unionByName(asked.exceptAll(listed).withColumn("only_in", F.lit("prompt")))
    used = triplets.groupBy(F.col("relation").alias("label")).agg(F.count("*").alias("uses"))
    return F.broadcast(only).join(used, "label", "left").select("label", "only_in", F.coalesce("uses", F.lit(0)).alias("uses"))
