"""Answers of an extractor, as JSON text, to validated records.

Each answer is parsed once to a variant; items are validated one by one, so one
bad item costs nothing but itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

TRIPLET_FIELDS = ("subject", "relation", "object", "article_number")
OPTIONAL_FIELDS = ("subject", "action", "object")


def parsed(answer: Column) -> Column:
    """The answer as a variant, without a Markdown fence around it; null if it is no JSON."""
    fenced = F.nullif(F.regexp_extract(answer, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    return F.try_parse_json(F.coalesce(fenced, answer))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_text(v: Column) -> Column:
    return F.coalesce(_kind(v) == "STRING", F.lit(False))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _read(answers: DataFrame) -> DataFrame:
    """The answers with their variant `_v` and its kind `_k`, each found once."""
    return answers.withColumn("_v", parsed(F.col("response"))).withColumn("_k", F.substring(_kind(F.col("_v")), 1, 5))


def _items(answers: DataFrame, outer: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    each = F.when(F.col("_k") == "ARRAY", F.try_variant_get(F.col("_v"), "$", "array<variant>")).when(F.col("_k") == "OBJEC", F.array("_v"))
    explode = F.posexplode_outer if outer else F.posexplode
    return _read(answers).select("doc_id", "pos", *keep, F.col("_v").isNull().alias("no_json"), explode(each).alias("item_pos", "item"))


def items(answers: DataFrame) -> DataFrame:
    """doc_id, pos, item_pos, item: a list's items, an object as the only item; nothing else gives rows."""
    return _items(answers, outer=False).drop("no_json")


def _fields(v: Column, names: tuple[str, ...]) -> Column:
    """The named fields of an object, as variants, in one go; null if it is none."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'{n}: variant' for n in names)}>")


def _checked(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_f", _fields(F.col("item"), (*TRIPLET_FIELDS, "confidence")))
    rows = rows.select("*", *(F.col(f"_f.{name}").alias(f"_{name}") for name in (*TRIPLET_FIELDS, "confidence")))
    given = F.col("_confidence")
    number = F.when(given.isNull(), F.lit(1.0)).when(F.is_variant_null(given), F.lit(None).cast("double")).otherwise(F.try_variant_get(given, "$", "double"))
    rows = rows.withColumn("_number", number)
    ok = F.col("_f").isNotNull() & F.col("_number").isNotNull()
    for name in TRIPLET_FIELDS:
        ok = ok & _is_text(F.col(f"_{name}"))
    return rows.withColumn("ok", F.coalesce(ok, F.lit(False)))


def checked_triplets(answers: DataFrame) -> DataFrame:
    """Items with their fields and `ok`.

    The four text fields must be strings; a missing confidence is 1, a null one or
    one that is no number fails; other keys are passed over.
    """
    fields = [_text(F.col(f"_{name}")).alias(name) for name in TRIPLET_FIELDS]
    return _checked(items(answers)).select("doc_id", "pos", "item_pos", *fields, F.col("_number").alias("confidence"), "ok")


def triplets(answers: DataFrame) -> DataFrame:
    return checked_triplets(answers).filter("ok").drop("ok")


def entities(answers: DataFrame) -> DataFrame:
    """One record for each article: the object, or the first item of a list, if valid; else the defaults.

    `answers` has doc_id, pos, article_text, response.  Optional fields may be
    missing or null, but not of another kind.
    """
    v = F.col("_v")
    rows = _read(answers).withColumn("_e", F.when(F.col("_k") == "ARRAY", F.try_variant_get(v, "$[0]", "variant")).otherwise(v))
    names = ("article_number", "concept", *OPTIONAL_FIELDS, "full_text")
    rows = rows.withColumn("_f", _fields(F.col("_e"), names))
    rows = rows.select("*", *(F.col(f"_f.{name}").alias(f"_{name}") for name in names))
    ok = F.col("_f").isNotNull()
    for name in names:
        here = F.col(f"_{name}")
        ok = ok & (_is_text(here) | here.isNull() | F.is_variant_null(here) if name in OPTIONAL_FIELDS else _is_text(here))
    default = {"article_number": F.lit(t.UNKNOWN), "concept": F.lit(t.UNKNOWN), "full_text": F.col("article_text")}
    rows = rows.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    fields = [F.when(F.col("_ok"), _text(F.col(f"_{n}"))).otherwise(default.get(n, F.lit(None).cast("string"))).alias(n) for n in names]
    return rows.select("doc_id", "pos", *fields)


def errors(answers: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """doc_id, pos, stage, message of answers that are no JSON, of rejected items, of triplets without an article.

    The answers are read, and each is parsed, once.  Where `answers` has an `error`, why the
    extractor gave no answer, the stage is extract and the message that.
    """
    failed = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    # What failed counts as no answer, so it gives one row whatever else stands there.
    read = answers.select("doc_id", "pos", F.when(failed.isNull(), F.col("response")).alias("response"), failed.alias("_failed"))
    rows = _checked(_items(read, outer=True, keep=("_failed",))).filter(F.col("no_json") | (F.col("item").isNotNull() & ~F.col("ok")))
    stage = F.when(F.col("_failed").isNotNull(), "extract").when(F.col("no_json"), "parse").otherwise("validate")
    message = F.coalesce("_failed", F.when(F.col("no_json"), "no JSON").otherwise("invalid item"))
    out = rows.select("doc_id", "pos", stage.alias("stage"), message.alias("message"))
    if dropped is not None:
        out = out.unionByName(dropped.select("doc_id", "pos", F.lit("match").alias("stage"), F.concat(F.lit("no article "), F.col("article_number")).alias("message")))
    return out


def error_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("stage", "message").agg(F.count("*").alias("errors"))


def quality(records: DataFrame) -> DataFrame:
    """For each document: records, how many are defaults, have a malformed number, lack an optional field."""
    number = F.col("article_number")
    return records.groupBy("doc_id").agg(
        F.count("*").alias("records"),
        F.count_if(number == t.UNKNOWN).alias("defaults"),
        F.count_if(~t.begins_article(number)).alias("malformed"),
        *(F.count_if(F.col(n).isNull()).alias(f"no_{n}") for n in OPTIONAL_FIELDS),
    )
