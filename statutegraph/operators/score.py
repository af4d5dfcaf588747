"""Batch scoring with a user's extractor, and a memory of what it has answered."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import kept, nothing

Scorer = Callable[[pd.Series], pd.Series]
#: Times that a prompt without an answer is asked, over all runs that share a memory.
ATTEMPTS = 3
MEMORY = "sha string, response string, error string, attempt int, run string"


def score(
    rows: DataFrame, prompt: str, fn: Scorer, out: str = "response", partitions: int | None = None, batch: int = 256, error: str | None = None, memory: str | None = None, attempts: int = ATTEMPTS, run: str | None = None
) -> DataFrame:
    """`rows` with the answer of `fn` to the prompt in column `prompt`, and why there is none as `error` if named.

    Equal prompts are asked once.  `partitions` bounds how many calls run at a
    time.  `fn` gets up to `batch` prompts and gives an answer, a string, for each, in
    their order.  If it fails on a batch, or gives too few or too many, the prompts go one
    by one; those that fail again, or get no answer or one that is no string, have null
    and the reason.  Answers are written before they are used, as asking again
    costs much and may answer otherwise.  A null prompt is not asked.

    With a folder `memory`, prompts that were answered in an earlier run are not
    asked again, and those that failed are, until they were asked `attempts` times.
    """
    spark = rows.sparkSession
    asked = rows.filter(F.col(prompt).isNotNull()).select(F.sha2(prompt, 256).alias("sha"), F.col(prompt).alias("_prompt"))
    asked = asked.groupBy("sha").agg(F.first("_prompt").alias("_prompt"))  # by digest, as the memory is: prompts move once
    if memory is None:
        found = kept(_asked(asked.withColumn("attempt", F.lit(1)), fn, batch, partitions), "answers")
    else:
        before = _remembered(spark, memory).groupBy("sha").agg(F.max(F.col("response").isNotNull()).alias("answered"), F.max("attempt").alias("attempts"))
        again = asked.join(before, "sha", "left").filter(~F.coalesce("answered", F.lit(False)) & (F.coalesce("attempts", F.lit(0)) < attempts))
        again = again.select("sha", "_prompt", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"))
        new = _asked(again, fn, batch, partitions).withColumn("run", F.lit(run or uuid.uuid4().hex))
        new.write.mode("append").parquet(memory)
        found = remembered(spark, memory)
    answers = found.select(F.col("sha").alias("_sha"), F.col("response").alias(out), *([F.col("error").alias(error)] if error else []))
    return rows.withColumn("_of", F.sha2(prompt, 256)).join(answers, F.col("_of") == F.col("_sha"), "left").drop("_of", "_sha")


def _remembered(spark: SparkSession, memory: str) -> DataFrame:
    try:
        return spark.read.schema(MEMORY).parquet(memory)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing(spark, MEMORY)


def remembered(spark: SparkSession, memory: str) -> DataFrame:
    """sha, response, error, attempts of each prompt that was ever asked; an answer of any attempt counts, the least of several."""
    every = _remembered(spark, memory).groupBy("sha").agg(F.min("response").alias("response"), F.max_by("error", "attempt").alias("error"), F.max("attempt").alias("attempts"))
    return every.withColumn("error", F.when(F.col("response").isNull(), F.col("error")))


def _asked(prompts: DataFrame, fn: Scorer, batch: int, partitions: int | None) -> DataFrame:
    """sha, response, error, attempt of the prompts (sha, _prompt, attempt)."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch].reset_index(drop=True)
                try:
                    answers = _answers(fn, part["_prompt"])
                except Exception:
                    answers = [_one(fn, p) for p in part["_prompt"]]
                responses, errors = zip(*answers)
                yield pd.DataFrame({"sha": part["sha"], "response": pd.Series(responses, dtype=object), "error": pd.Series(errors, dtype=object), "attempt": part["attempt"]})

    prompts = prompts.repartition(partitions) if partitions else prompts
    return prompts.mapInPandas(ask, "sha string, response string, error string, attempt int")


def _answers(fn: Scorer, prompts: pd.Series) -> list[tuple[str | None, str | None]]:
    """Answer and reason for each prompt, by position; an error if there are not as many answers as prompts."""
    got = list(fn(prompts))
    if len(got) != len(prompts):
        raise ValueError(f"{len(got)} answers to {len(prompts)} prompts")
    return [(x, None) if isinstance(x, str) else (None, "no answer" if x is None or x is pd.NA or x != x else f"an answer that is no string but {type(x).__name__}") for x in got]


def _one(fn: Scorer, prompt: str) -> tuple[str | None, str | None]:
    try:
        return _answers(fn, pd.Series([prompt], dtype=object))[0]
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"
