"""A graph as Parquet tables in a folder, saved by numbered commits.

A save writes folders of its own and counts from its commit on: a small file named
by the next number, which only one of several writers can create.  A writer that
finds its number taken takes out of what it wrote what the others have brought, and
tries the next.  So saves may run at once, one that breaks off leaves nothing that
is read, and a micro-batch that runs again finds its commit and adds nothing.

Next to the five tables each save keeps the sums that statistics ask for, so these
are answered without reading an edge.  Entities lie in folders by a hash of their
name, so a save looks for its names only where they can be.  Articles and relations
are ordered by article number, so a lookup skips the rest.  Many small saves are
merged by compact().
"""

from __future__ import annotations

import json
import random
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import graph as g
from ..storage import kept, nothing
from . import files

TABLES = ("documents", "articles", "entities", "contains", "relations")
#: What is wrong with what was saved; a graph may have it.
ERRORS = "doc_id long, pos long, stage string, message string"
#: Folders that the names of entities are dealt to.
BUCKETS = 16
_OWN = {"entities": "name string, bucket int", "tallies": "name string, relation string, n long, kind string", "errors": ERRORS}
_FOLDERS = {"entities": "bucket", "tallies": "kind"}
#: Articles and relations are ordered by these, with Bloom filters on the first.
_ORDER = {"documents": ("doc_id",), "articles": ("article_number", "doc_id", "pos"), "contains": ("doc_id", "pos"), "relations": ("article", "doc_id", "pos")}
#: Rows of one table that are sent to all machines, at most.
BROADCAST_ROWS = 200_000
#: Tries of a commit.
ATTEMPTS = 100
#: A save joins a merge unless it is this many times as large as all smaller ones together.
TIER = 4
_LOG = "version long, kind string, save string, saves array<string>, stream string, batch long, streams map<string,long>, schemas map<string,string>, counts map<string,map<string,long>>"


@dataclass
class Graph:
    documents: DataFrame
    articles: DataFrame
    entities: DataFrame
    contains: DataFrame
    relations: DataFrame
    errors: DataFrame | None = None


@dataclass
class State:
    """What the commits up to `version` amount to: the saves that count, the last batch of each stream, the rows of each save."""

    version: int = -1
    saves: list[str] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def table_path(path: str, name: str, save: str | None = None) -> str:
    return f"{path.rstrip('/')}/{name}" + (f"/save={save}" if save else "")


def state(spark: SparkSession, path: str) -> State:
    """The commits in order; those before the last merge are no longer needed."""
    try:
        rows = spark.read.schema(_LOG).json(table_path(path, "saves")).collect()  # a row for each commit since the last vacuum()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return State()
    out = State()
    for r in sorted(rows, key=lambda r: r["version"]):
        out.version, out.schemas = r["version"], r["schemas"]
        if r["kind"] == "merge":
            out.saves, out.streams, out.counts = list(r["saves"]), dict(r["streams"]), dict(r["counts"])
            continue
        out.saves = [r["save"]] if r["kind"] == "clear" else [*out.saves, r["save"]]
        out.counts |= r["counts"]
        if r["stream"] is not None:
            out.streams[r["stream"]] = max(r["batch"], out.streams.get(r["stream"], -1))
    return out


def _commit(spark: SparkSession, path: str, version: int, **entry) -> bool:
    return files.publish(spark, table_path(path, "saves"), f"{version:020}.json", json.dumps({"version": version} | entry) + "\n")


def _read(spark: SparkSession, path: str, name: str, saves: list[str], schema: str | T.StructType) -> DataFrame:
    paths = [table_path(path, name, x) for x in saves]
    if not paths:
        return nothing(spark, schema)
    # Saves one by one where folders stand for a column, as they have no common root.
    reader = spark.read.schema(schema)
    return reduce(DataFrame.unionByName, (reader.parquet(p) for p in paths)) if name in _FOLDERS else reader.parquet(*paths)


def _table(spark: SparkSession, path: str, now: State, name: str, saves: list[str] | None = None) -> DataFrame:
    saves = [x for x in (now.saves if saves is None else saves) if now.counts[x].get(name)]
    return _read(spark, path, name, saves, _OWN.get(name) or T.StructType.fromJson(json.loads(now.schemas[name])))


def _there(spark: SparkSession, path: str) -> State:
    now = state(spark, path)
    if not now.saves:
        raise FileNotFoundError(f"no graph was saved in {path}")
    return now


def load(spark: SparkSession, path: str) -> Graph:
    now = _there(spark, path)
    every = {name: _table(spark, path, now, name) for name in (*TABLES, "errors")}
    return Graph(**every | {"entities": every["entities"].select("name")})


# ---------------------------------------------------------------- saving


def bucket(name: str = "name"):
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int")


def present(keys: DataFrame, stored: DataFrame, small: bool | None = None) -> DataFrame:
    """The rows of `keys`, a staged column of distinct values, that `stored` has.

    A batch's keys go to the stored rows, which stay where they are and are only
    filtered; where there are too many keys for that, both sides meet by shuffle.
    """
    (column,) = keys.columns
    small = keys.count() <= BROADCAST_ROWS if small is None else small
    return stored.select(column).join(F.broadcast(keys) if small else keys, column, "left_semi").distinct()


def absent(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of `keys` that `stored` does not have, as present() finds those that it has."""
    (column,) = keys.columns
    small = keys.count() <= BROADCAST_ROWS
    hit = present(keys, stored, small)
    return keys.join(F.broadcast(hit) if small else hit, column, "left_anti")


def _of_new(rows: DataFrame, ids: DataFrame, there: DataFrame) -> DataFrame:
    """Rows of those `ids` that are not `there`; both are staged.

    Where few are there, which is the rule, these are sent to the rows, however
    many the others are; so articles and edges stay where they are.
    """
    few = there.count() <= BROADCAST_ROWS
    if few:
        return rows.filter(F.col("doc_id").isNotNull()).join(F.broadcast(there), "doc_id", "left_anti")
    return rows.join(ids.join(there, "doc_id", "left_anti"), "doc_id", "left_semi")


def new_names(names: DataFrame, stored: DataFrame) -> DataFrame:
    """The staged distinct `names` that the entities `stored` (name, bucket) lack; only the buckets of these names are read."""
    touched = [r[0] for r in names.select(bucket()).distinct().collect()]  # BUCKETS at most
    return absent(names, stored.filter(F.col("bucket").isin(touched)))


def tallies(relations: DataFrame) -> DataFrame:
    """The edges counted by object, by relation, and by subject and relation: sums that add up over saves."""
    n = F.col("multiplicity") if "multiplicity" in relations.columns else F.lit(1)
    none = F.lit(None).cast("string")
    each = F.array(
        F.struct(F.lit("object").alias("kind"), F.col("object").alias("name"), none.alias("relation")),
        F.struct(F.lit("relation").alias("kind"), none.alias("name"), F.col("relation").alias("relation")),
        F.struct(F.lit("subject").alias("kind"), F.col("subject").alias("name"), F.col("relation").alias("relation")),
    )
    return added_up(relations.select(F.explode(each).alias("t"), n.cast("long").alias("n")).select("t.*", "n"))


def added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "name", "relation").agg(F.sum("n").alias("n"))


def _put(rows: DataFrame, path: str, name: str, save: str) -> DataFrame:
    """Written, read again, with columns in the order of their table."""
    schema = rows.schema if name not in _OWN else T._parse_datatype_string(_OWN[name])
    rows = rows.select(*schema.names)
    if name in _ORDER and set(_ORDER[name]) <= set(rows.columns):
        rows = rows.sortWithinPartitions(*_ORDER[name])
    out = rows.write.mode("overwrite")
    if name in _FOLDERS:
        out = out.partitionBy(_FOLDERS[name])
    if name in ("articles", "relations"):
        out = out.option(f"parquet.bloom.filter.enabled#{_ORDER[name][0]}", "true")
    out.parquet(table_path(path, name, save))
    return rows.sparkSession.read.schema(schema).parquet(table_path(path, name, save))


def _write(graph: Graph, path: str, save: str, now: State, others: list[str], unseen: list[str], skip: bool) -> tuple[dict[str, int], dict[str, str]]:
    """Write a save next to `others`: documents that those have are left out with all that hangs on them if `skip`, their entities always.

    Documents of `others` that are not `unseen` are known to be left out already.
    Entities are those of the relations that are written.
    """
    spark = graph.documents.sparkSession
    parts = {name: getattr(graph, name) for name in ("documents", "articles", "contains", "relations", "errors")}
    if unseen and skip:
        ids = kept(parts["documents"].select("doc_id").distinct(), "arriving-documents")
        there = kept(present(ids, _table(spark, path, now, "documents", unseen)), "documents-there")
        for name in ("documents", "articles", "contains", "relations"):
            parts[name] = _of_new(parts[name], ids, there)
    written = {name: _put(rows, path, name, save) for name, rows in parts.items() if rows is not None}
    names = written["relations"].select(F.explode(F.array("subject", "object")).alias("name")).distinct()
    if others:
        names = new_names(kept(names, "arriving-names"), _table(spark, path, now, "entities", others))
    written["entities"] = _put(names.withColumn("bucket", bucket()), path, "entities", save)
    written["tallies"] = _put(tallies(written["relations"]), path, "tallies", save)
    schemas = {name: rows.schema.json() for name, rows in written.items() if name not in _OWN}
    for name, schema in schemas.items():
        was = T.StructType.fromJson(json.loads(now.schemas[name])).simpleString() if others else None
        if was and was != T.StructType.fromJson(json.loads(schema)).simpleString():
            raise ValueError(f"{name} has other columns than those saved before: {was}")
    return {name: rows.count() for name, rows in written.items()}, schemas  # from the footers


def _save(graph: Graph, path: str, kind: str, skip: bool, stream: str | None = None, batch: int | None = None) -> None:
    spark = graph.documents.sparkSession
    own, seen, now = None, [], state(spark, path)
    for attempt in range(ATTEMPTS):
        if stream is not None and now.streams.get(stream, -1) >= batch:
            return
        others = [] if kind == "clear" else now.saves
        if own is not None and set(seen) <= set(others):  # what was written lacks only a look at what came since
            mine = State(counts={own: counts}, schemas=schemas)
            graph_ = Graph(**{name: _table(spark, path, mine, name, [own]) for name in (*TABLES, "errors")})
            unseen = [x for x in others if x not in seen]
        else:
            graph_, unseen = graph, others
        own = uuid.uuid4().hex
        counts, schemas = _write(graph_, path, own, now, others, unseen, skip)
        if _commit(spark, path, now.version + 1, kind=kind, save=own, stream=stream, batch=batch, schemas=schemas, counts={own: counts}):
            return
        time.sleep(random.uniform(0, 0.05 * 2 ** min(attempt, 6)))
        seen, now = others, state(spark, path)
    raise RuntimeError(f"{ATTEMPTS} other saves came first")


def save(graph: Graph, path: str, clear: bool = False, on_duplicate: str = "skip") -> None:
    """Write a graph, in place of what is there or added to it.

    Adding skips documents that are there already, with all that hangs on them,
    unless on_duplicate="append".  Entities are created only where absent.  Saves
    that run at once come one after the other, in some order.
    """
    if on_duplicate not in ("skip", "append"):
        raise ValueError(f"on_duplicate is skip or append, not {on_duplicate!r}")
    _save(graph, path, "clear" if clear else "add", on_duplicate == "skip")


def save_batch(graph: Graph, path: str, batch_id: int, stream: str = "", compact_every: int | None = None) -> None:
    """Write micro-batch `batch_id` of a stream, unless that or a later one of it was saved before.

    Batches of other streams have numbers of their own.  Documents that other saves
    brought are skipped, with all that hangs on them, and entities are created only
    where no other save did.  Once there are `compact_every` saves they are merged,
    and what no one reads any more is removed after a day.
    """
    _save(graph, path, "add", True, stream, batch_id)
    spark = graph.documents.sparkSession
    if compact_every and len(state(spark, path).saves) >= compact_every:
        compact(spark, path)
        vacuum(spark, path)


# ---------------------------------------------------------------- merging


def _small_ones(now: State) -> list[str]:
    """The saves to merge: smallest first, up to one that is much larger than all before it, so that few rows are written often."""
    rows = sorted((sum(now.counts[x].get(name, 0) for name in TABLES), x) for x in now.saves)
    out, total = [], 0
    for n, x in rows:
        if len(out) > 1 and n > TIER * max(total, 1):
            break
        out.append(x)
        total += n
    return out if len(out) > 1 else []


def compact(spark: SparkSession, path: str, everything: bool = False) -> None:
    """Merge small saves, or all, into one, ordered for lookups, with each entity once and sums added up.

    Saves that are committed meanwhile stay beside it.  What was merged is still on
    disk, for those who read it, until vacuum().
    """
    for _ in range(ATTEMPTS):
        now = state(spark, path)
        merged = (now.saves if len(now.saves) > 1 else []) if everything else _small_ones(now)
        if not merged:
            return
        own, written = uuid.uuid4().hex, {}
        for name in (*TABLES, "errors", "tallies"):
            rows = _table(spark, path, now, name, merged)
            if name in _ORDER and set(_ORDER[name]) <= set(rows.columns):
                rows = rows.repartitionByRange(*_ORDER[name])
            elif name == "entities":
                rows = rows.distinct().repartition("bucket")
            elif name == "tallies":
                rows = added_up(rows)
            written[name] = _put(rows, path, name, own)
        counts = {name: rows.count() for name, rows in written.items()}
        while set(merged) <= set(now.saves):
            live = [own, *(x for x in now.saves if x not in merged)]
            rest = {x: now.counts[x] for x in live if x != own} | {own: counts}
            if _commit(spark, path, now.version + 1, kind="merge", save=own, saves=live, streams=now.streams, schemas=now.schemas, counts=rest):
                return
            now = state(spark, path)


def vacuum(spark: SparkSession, path: str, older_than: float = 86_400) -> int:
    """Remove what the commits no longer name, and commits before the last merge, once it is `older_than` seconds old; how many that were.

    Readers and writers that take longer than that lose what they use.
    """
    now, before = state(spark, path), (time.time() - older_than) * 1000
    gone = 0
    for name in (*TABLES, "errors", "tallies"):
        for folder, changed in files.listed(spark, table_path(path, name)):
            if changed < before and folder.startswith("save=") and folder[5:] not in now.saves:
                files.removed(spark, f"{table_path(path, name)}/{folder}")
                gone += 1
    log = table_path(path, "saves")
    merges = [r["version"] for r in spark.read.schema(_LOG).json(log).filter("kind = 'merge'").select("version").collect()] if now.version >= 0 else []
    for name, changed in files.listed(spark, log):
        if changed < before and merges and name.endswith(".json") and int(name[:-5]) < max(merges):
            files.removed(spark, f"{log}/{name}")
            gone += 1
    return gone


# ---------------------------------------------------------------- questions to a stored graph


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row: documents, articles, entities, relations (edges as often as they stand), all from the commits and sums."""
    now = _there(spark, path)
    total = {name: sum(now.counts[x].get(name, 0) for x in now.saves) for name in TABLES}
    edges = _tallied(spark, path, now, "relation").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("edges"))
    return edges.select(*(F.lit(total[name]).cast("long").alias(name) for name in ("documents", "articles", "entities", "relations")), "edges")


def _tallied(spark: SparkSession, path: str, now: State, kind: str) -> DataFrame:
    return _table(spark, path, now, "tallies").filter(F.col("kind") == kind)


def top_entities(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """Entities by incoming edges, ties by name: the saves' sums added up."""
    rows = _tallied(spark, path, _there(spark, path), "object").groupBy("name").agg(F.sum("n").alias("refs"))
    return rows.orderBy(F.desc("refs"), "name").limit(n)


def relation_counts(spark: SparkSession, path: str) -> DataFrame:
    return _tallied(spark, path, _there(spark, path), "relation").groupBy("relation").agg(F.sum("n").alias("edges"))


def edges_by_subject(spark: SparkSession, path: str) -> DataFrame:
    rows = added_up(_tallied(spark, path, _there(spark, path), "subject"))
    return rows.groupBy(F.col("name").alias("subject")).agg(F.sum("n").alias("edges"), F.count("*").alias("relations"))


def relations_of(spark: SparkSession, path: str, numbers: list[str]) -> DataFrame:
    """Edges that came from some article numbers, `article` among the columns; the scan leaves out row groups without them."""
    return load(spark, path).relations.filter(F.col("article").isin(numbers))


def article_lookup(spark: SparkSession, path: str, numbers: list[str]) -> DataFrame:
    """For each number the first article that has it, by document and position; nulls if none."""
    asked = F.array(*map(F.lit, dict.fromkeys(numbers))).cast("array<string>")
    keys = spark.range(1).select(F.explode(asked).alias("article_number"))
    found = load(spark, path).articles.filter(F.col("article_number").isin(numbers))
    first = found.groupBy("article_number").agg(F.min(F.struct("doc_id", "pos")).alias("_at"))  # narrow rows, combined where they are
    first = kept(first.select("article_number", "_at.*"), "first-articles")  # one for each number asked
    rows = found.join(F.broadcast(first), ["article_number", "doc_id", "pos"]).dropDuplicates(["article_number"])
    return keys.join(F.broadcast(rows), "article_number", "left").select(*found.columns)
