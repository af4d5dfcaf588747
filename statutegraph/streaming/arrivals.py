"""Documents that arrive one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as t
from ..operators import articles as art
from ..plans.corpus import build
from ..schemas import DOCUMENTS
from ..sources import store
from ..storage import kept


def arriving(spark: SparkSession, directory: str, schema=DOCUMENTS, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(directory)


def split_stream(docs: DataFrame, sink: str, checkpoint: str, clean: bool = False) -> StreamingQuery:
    """Articles of arriving documents, appended to Parquet; a document is one row, so no state is kept."""
    docs = docs.withColumn("content", t.clean_text(F.col("content"))) if clean else docs
    pieces = art.articles(docs)
    return pieces.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest_versions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each document's version of the highest load_seq, ties by the highest digest; and the others as errors.

    The choice depends on the rows alone, so a batch that runs again chooses alike.
    Documents that come once, most or all, are neither digested nor moved.
    """
    repeated = kept(docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n")).filter("n > 1").select("_id"), "repeated-documents")
    many = repeated.count()
    if not many:
        return docs, docs.select("doc_id", F.lit(None).cast("long").alias("pos"), F.lit("arrive").alias("stage"), F.lit("").alias("message")).filter(F.lit(False))
    repeated = F.broadcast(repeated) if many <= store.BROADCAST_ROWS else repeated
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    chosen, others = _latest(docs.join(repeated, same, "left_semi"))
    return docs.join(repeated, same, "left_anti").unionByName(chosen), others


def _latest(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    digest = F.sha2(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in sorted(docs.columns))), 256)
    rows = docs.withColumn("_v", F.struct(F.coalesce("load_seq", F.lit(-(1 << 63))).alias("seq"), digest.alias("digest")))
    last = rows.groupBy("doc_id").agg(F.max("_v").alias("_last"))
    judged = rows.join(last.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    chosen = judged.filter(F.col("_v") == F.col("_last")).select(*docs.columns).dropDuplicates(["doc_id"])  # equal rows are left
    message = F.concat(F.lit("superseded by load_seq "), F.col("_last.seq"))
    others = judged.filter(F.col("_v") != F.col("_last")).select("doc_id", F.lit(None).cast("long").alias("pos"), F.lit("arrive").alias("stage"), message.alias("message"))
    return chosen, others


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream whose state is in `checkpoint`; it stays through restarts, and another checkpoint is another stream."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def append_stream(docs: DataFrame, path: str, checkpoint: str, mode: str = "heading", compact_every: int | None = 50) -> StreamingQuery:
    """Arriving documents into the graph at `path`, to which others may save meanwhile.

    A document is never split over batches, so a batch's triplets are deduplicated
    within it; of several versions in one batch the latest counts, the others stand in the
    graph's errors.  A batch is known by its stream and number, so one that runs
    again after a failure adds nothing.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch, others = latest_versions(batch)
        pieces = kept(art.articles(batch, mode), "arriving-articles")  # split once; four tables come from them
        graph = build(batch, pieces=pieces)
        graph.errors = others
        store.save_batch(graph, path, batch_id, stream_name(batch.sparkSession, checkpoint), compact_every)

    return docs.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
