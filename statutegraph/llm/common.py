"""Helpers the operators share: staged tables, exact ranks, word hashing."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import kept as staged

#: Separators between words in contracts that say ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"

#: monotonically_increasing_id() keeps the row number of a partition in so many low bits.
ROW_BITS = 33


#: Rows with whole texts that go to a Python worker at once; Spark's own default of 10,000
#: holds tens of megabytes of text several times over on either side.
TEXTS_A_BATCH = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the texts in a batch for the session, unless it has a bound of its own."""
    if spark.conf.get(_ARROW_ROWS) == "10000":
        spark.conf.set(_ARROW_ROWS, str(TEXTS_A_BATCH))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that `df` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        at = f"__{name}"
        while at.lower() in taken:
            at += "_"
        taken.add(at.lower())
        out.append(at)
    return out


def placed_in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Range-shuffle and sort rows by `order`, and number them.

    Adds `_part` (ascending with the order) and `_row` (gapless in the part).
    The order should hold a tie-break so that no single value fills a part.
    The result is staged: numbers stay what they are.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return staged(
        rows.withColumn("_part", F.shiftright("_at", ROW_BITS)).withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop("_at"),
        name,
    )


def ranked(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Rows with `_rank`, gapless from 0 over the whole order, and their number.

    One range shuffle; no task sees more than its range.  What is broadcast is
    one row for each range partition.
    """
    rows = placed_in_order(df, order, name)
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect())  # a row for each range partition
    total, starts = 0, []
    for part, n in counts:
        starts.append((part, total))
        total += n
    first = df.sparkSession.createDataFrame(starts, "_part long, _first long")
    out = rows.join(F.broadcast(first), "_part").withColumn("_rank", F.col("_first") + F.col("_row")).drop("_part", "_row", "_first")
    return out, total


def row_key(*columns: Column) -> Column:
    """Columns as one string that is never null and tells null from everything else."""
    return F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns))


#: Rows of one key that a task numbers by itself, at most.
REPEATS = 1000


def attached(docs: DataFrame, key: Column, decided: DataFrame, decided_key: Column, decision: Column) -> DataFrame:
    """Whole rows of `docs` as the struct `doc`, each with a decision of its key as `got`.

    Decisions are made on narrow rows; here the rows themselves move, once.  Rows
    that repeat a key, which holds their id, get a decision each, whichever.  Keys
    that more than REPEATS rows share are numbered on both sides by a range
    shuffle, so that none of them fills a task.  Nothing in, nothing out; columns
    of `docs` may have any name, as they travel in the struct.
    """
    found = decided.select(decided_key.alias("_key"), decision.alias("got"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), key.alias("_key"))
    many = staged(found.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > REPEATS), "repeated-keys")
    if many.isEmpty():
        return _dealt(rows, found)
    few = _dealt(without_group(rows, many, "_key", "_n"), without_group(found, many, "_key", "_n"))
    left, _ = ranked(with_group(rows, many, "_key", "_n"), [F.col("_key"), F.rand(1)], "repeated-rows")
    right, _ = ranked(with_group(found, many, "_key", "_n"), [F.col("_key"), F.rand(2)], "repeated-decisions")
    # Both sides hold the same number of each key, so equal ranks have equal keys.
    return few.unionByName(left.select("doc", "_rank").join(right.select("got", "_rank"), "_rank").select("doc", "got"))


def _dealt(rows: DataFrame, found: DataFrame) -> DataFrame:
    each = found.groupBy("_key").agg(F.collect_list("got").alias("_all"))
    at = F.row_number().over(W.partitionBy("_key").orderBy("_key"))
    return rows.join(each, "_key").withColumn("got", F.get("_all", at - 1)).select("doc", "got")


#: Groups with at least this share of all rows are hot; there are no more of them than its inverse.
HOT = 1000


def _hot(groups: DataFrame, size: str) -> tuple[DataFrame, DataFrame]:
    total = groups.agg(F.sum(size)).first()[0] or 0
    return groups.filter(F.col(size) * HOT >= total), groups.filter(F.col(size) * HOT < total)


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Join (`how`: inner or left) of `rows` with their group's row, of which `size` is the number of rows.

    Groups of at least a thousandth of all rows, a thousand at most, are
    broadcast, so that no task gets all rows of a large one; the others shuffle.
    `groups` should be staged, as it is read three times.  Null keys meet nothing.
    """
    hot, rest = _hot(groups, size)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, how)
    return rows.join(F.broadcast(hot), key).unionByName(far)


def without_group(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """The rows that have no group, by the same ways."""
    hot, rest = _hot(groups, size)
    return rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest.select(key), key, "left_anti")


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all the runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


# ---------------------------------------------------------------- word hashing

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = 0x100000001B3) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _word_table() -> np.ndarray:
    """True for the code points of words: letters, marks and digits of any script, and the underscore."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" or c == 0x5F for c in range(0x110000)], dtype=bool)


def _in_words(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 whether it belongs to a character of words."""
    table = _word_table()
    inside = table[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return inside
    inside[data >= 0x80] = False
    first = data[lead].astype(np.int64)
    width = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first & (0xFF >> (width + 1))
    for k in (1, 2, 3):
        at = np.minimum(lead + k, len(data) - 1)
        code = np.where(width > k, code << 6 | data[at] & 0x3F, code)
    good = table[np.minimum(code, 0x10FFFF)]
    for k in (0, 1, 2, 3):
        at = lead[good & (width > k)] + k
        inside[at[at < len(data)]] = True
    return inside


def word_spans(data: np.ndarray, *, punctuation: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes.

    punctuation=False: words lie between ASCII white space.  True: words are
    runs of letters, marks and digits by their Unicode category, and underscores.
    """
    inside = _in_words(data) if punctuation else ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes alone."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lens = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lens)[:-1]))
    within = np.arange(int(lens.sum())) - np.repeat(offsets, lens)
    chars = data[np.repeat(starts, lens) + within].astype(np.uint64) + np.uint64(1)
    return mix64(np.add.reduceat(chars * powers(int(lens.max()))[within], offsets) + lens.astype(np.uint64) * _MULT)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows; a shorter sequence is one shingle, no word none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    for j, c in enumerate(powers(k + 1, 0xD6E8FEB86659FD93)[1:]):
        out += words[j : n - k + 1 + j] * c
    return mix64(out)


#: Texts are hashed in groups of about so many bytes, so that memory stays bounded.
GROUP_BYTES = 1 << 18


def groups_of_texts(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about GROUP_BYTES; a longer text is alone."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        if group and size + len(t) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def hashed_texts(texts: Iterable[bytes], k: int, *, punctuation: bool) -> Iterator[np.ndarray]:
    """For each text its array of k-word shingle hashes (repeats included)."""
    for group in groups_of_texts(texts):
        data = np.frombuffer(b"\n".join(group), dtype=np.uint8)
        starts, ends = word_spans(data, punctuation=punctuation)
        words = word_hashes(data, starts, ends)
        bounds = np.cumsum([len(t) + 1 for t in group])
        cut = np.searchsorted(starts, bounds)
        at = 0
        for to in cut:
            yield shingle_hashes(words[at:to], k)
            at = to
