"""Page and metadata tables of PDF files to documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as t
from ..storage import kept


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """path, length of the PDF files right in a directory; an absent one gives none."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(directory)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long")
    return found.select("path", "length")


def assemble_pages(pages: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """path, content: the pages that are not blank, as they are, in order, with blank lines between, stripped.

    A file whose pages are all blank has the empty content; `files` adds those without any page.
    """
    shown = F.when(t.strip(F.col("text")) != "", F.struct("page_num", "text"))
    joined = pages.groupBy("path").agg(F.array_sort(F.collect_list(shown)).alias("p"))  # nulls are left out
    out = joined.select("path", t.strip(F.concat_ws("\n\n", F.transform("p", lambda x: x["text"]))).alias("content"))
    if files is not None:
        out = files.select("path").distinct().join(out, "path", "left").select("path", F.coalesce("content", F.lit("")).alias("content"))
    return out


def documents(meta: DataFrame, contents: DataFrame) -> DataFrame:
    """path, title, law_number, content of the files without an error.

    Title: that of the metadata, else its subject, else the file's stem.
    """
    stem = F.regexp_replace("filename", r"(?s)(?<=.)\.[^.]+$", "")
    title = F.coalesce(F.nullif("title", F.lit("")), F.nullif("subject", F.lit("")), stem)
    good = meta.filter("error IS NULL")
    return good.join(contents, "path").select("path", title.alias("title"), F.concat(F.lit("PDF 문서 - "), "filename").alias("law_number"), "content")


def described(meta: DataFrame) -> DataFrame:
    """The metadata with blanks and no pages where it could not be read; `error` says why."""
    bad = F.col("error").isNotNull()
    blank = {c: F.when(bad, F.lit("")).otherwise(F.col(c)) for c in ("title", "author", "subject")}
    return meta.withColumns(blank | {"pages": F.when(bad, F.lit(0)).otherwise(F.col("pages"))})


def without_text(meta: DataFrame, pages: DataFrame) -> DataFrame:
    """Files of readable metadata that tells of pages, of which none could be read."""
    return meta.filter("error IS NULL AND pages > 0").join(pages.select("path").distinct(), "path", "left_anti")


def failures(meta: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """path, stage, message of files whose metadata could not be read and, given the pages, of those without text; one never fails the job."""
    out = meta.filter("error IS NOT NULL").select("path", F.lit("metadata").alias("stage"), F.col("error").alias("message"))
    if pages is not None:
        out = out.unionByName(without_text(meta, pages).select("path", F.lit("text").alias("stage"), F.lit("no page could be read").alias("message")))
    return out


#: What may be the beginning of a marker that goes on on the next page: at a page's end, or all of a page.
_OPEN = rf"{t.UNICODE}제{t.SPACE}*(?:\d+{t.SPACE}*(?:조{t.SPACE}*(?:의{t.SPACE}*(?:\d+{t.SPACE}*)?)?(?:제{t.SPACE}*(?:\d+{t.SPACE}*(?:항{t.SPACE}*)?)?)?)?)?\z|\A[제조의항\d\s\x1c-\x1f]*\z"


def page_articles(pages: DataFrame, mode: str = "citation", clean: bool = False) -> DataFrame:
    """path, pos, article_text: the articles of assemble_pages()' contents, found page by page.

    No file is put together, so it need not fit a row, only each article.  A page that
    may end inside a marker is joined with the next one; each such run is cut by
    itself; what stands before its first marker goes to the last article before it.
    Which that is, counts of pages and markers tell.  Page numbers are unique in a
    file.  `clean` makes every run of white space one space, as clean_text() does.
    """
    shown = pages.filter(t.strip(F.col("text")) != "")
    order = W.partitionBy("path").orderBy("page_num")
    ends = shown.select("path", "page_num", F.col("text").rlike(_OPEN).alias("open"))
    goes_on = F.coalesce(F.lag("open").over(order), F.lit(False))
    runs = ends.withColumn("new", (~goes_on).cast("long")).select("path", "page_num", F.sum("new").over(order).alias("run"))
    joined = shown.join(runs, ["path", "page_num"]).groupBy("path", "run").agg(F.array_sort(F.collect_list(F.struct("page_num", "text"))).alias("p"))
    text = F.concat_ws("\n\n", F.transform("p", lambda x: x["text"]))
    cut = joined.select("path", "run", t.raw_pieces(text, mode).alias("pieces"))
    cut = kept(cut.select("path", "run", "pieces", t.begins_article(F.get("pieces", 0), mode).alias("begins")), "page-pieces")
    # Of a run's pieces only the first may begin without a marker.
    counts = cut.select("path", "run", (F.size("pieces") - 1 + F.col("begins").cast("int")).cast("long").alias("n"))
    before = F.sum("n").over(W.partitionBy("path").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    placed = counts.select("path", "run", F.coalesce(before, F.lit(0)).alias("base"), F.sum("n").over(W.partitionBy("path")).alias("articles"))
    rows = cut.join(placed, ["path", "run"]).select("path", "run", "base", "articles", "begins", F.size("pieces").alias("of"), F.posexplode("pieces").alias("i", "piece"))
    number = F.col("base") + F.col("i") + F.col("begins").cast("int")  # 0: before any marker
    rows = rows.withColumn("number", number).filter((F.col("number") > 0) | (F.col("articles") == 0))
    whole = ((F.col("i") > 0) | F.col("begins")) & (F.col("i") < F.col("of") - 1)
    parts = rows.filter(~whole).groupBy("path", "number").agg(F.array_sort(F.collect_list(F.struct("run", "piece"))).alias("p"))
    parts = parts.select("path", "number", F.concat_ws("\n\n", F.transform("p", lambda x: x["piece"])).alias("piece"))
    found = rows.filter(whole).select("path", "number", "piece").unionByName(parts)
    blank = pages.select("path").distinct().join(shown.select("path").distinct(), "path", "left_anti").select("path", F.lit(0).cast("long").alias("number"), F.lit("").alias("piece"))
    article = (t.clean_text if clean else t.strip)(F.col("piece"))
    return found.unionByName(blank).select("path", F.greatest(F.col("number") - 1, F.lit(0)).alias("pos"), article.alias("article_text"))
