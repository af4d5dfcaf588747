"""Benchmark decontamination by containment search.

Test items are short and documents long, so what counts is how much of an item
a document holds.  Items are partitioned by size, each class with an index and a
threshold of its own: of an item with n distinct shingles, of which at least m
must be in a document, the bottom-k MinHash sketch with k = n - m + 1 goes into
its class.  A document that holds m of them holds at least one of the k, so the
search misses nothing; a class whose least m is more than the document's
shingles is passed over.  What is found is verified by exact containment of the
shingles themselves.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import groups_of_texts, hashed_texts, shingle_hashes, small_batches, word_hashes, word_spans

WORDS = 5
CONTAINED = 0.8
#: Items go to the tasks in blocks of about so many bytes of text, one scan of the documents for each.
BLOCK_BYTES = 16 << 20


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _words(data: bytes) -> list[bytes]:
    starts, ends = word_spans(np.frombuffer(data, dtype=np.uint8), punctuation=True)
    return [data[a:b] for a, b in zip(starts, ends)]


def needed(n: int, contained: float) -> int:
    """The least number of n shingles that is a share of `contained`."""
    return max(1, math.ceil(contained * n - 1e-9))


def _ragged(parts: list[np.ndarray], kind) -> tuple[np.ndarray, np.ndarray]:
    """Arrays one behind the other, and where each begins."""
    starts = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, dtype=kind), starts


class SizeClass:
    """Items whose numbers of shingles have one binary exponent, by the hashes of their sketches."""

    def __init__(self, items: list[int], hashes: list[np.ndarray], need: list[int]):
        self.least = min(need)
        sketches = [h[: len(h) - m + 1] for h, m in zip(hashes, need)]
        keys = np.concatenate(sketches)
        owner = np.repeat(np.array(items, dtype=np.int32), [len(x) for x in sketches])
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.starts = np.append(first, len(keys))
        self.owner = owner[order]
        # Low bits of the keys, to pass over most shingles of a document at once.
        bits = 1 << min(24, max(16, (64 * len(self.keys)).bit_length()))
        self.bitmap = np.zeros(bits, dtype=bool)
        self.bitmap[(self.keys & np.uint64(bits - 1)).astype(np.int64)] = True

    def near(self, h: np.ndarray) -> np.ndarray:
        """Items whose sketches share a hash with h."""
        if len(h) < self.least:
            return np.empty(0, dtype=np.int32)
        h = h[self.bitmap[(h & np.uint64(len(self.bitmap) - 1)).astype(np.int64)]]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        found = np.unique(at[self.keys[at] == h])
        return np.unique(np.concatenate([self.owner[self.starts[i] : self.starts[i + 1]] for i in found])) if len(found) else np.empty(0, dtype=np.int32)


class Index:
    """Items of a block as arrays: their ids, texts and shingle hashes, and the size classes over them."""

    def __init__(self, items: list[tuple], words: int, contained: float):
        self.words = words
        kept: list[tuple] = []
        for i, text in items:
            data = _bytes(text)
            arr = np.frombuffer(data, dtype=np.uint8)
            starts, ends = word_spans(arr, punctuation=True)
            if len(starts) >= words:
                kept.append((i, data, np.unique(shingle_hashes(word_hashes(arr, starts, ends), words))))
        self.ids = [k[0] for k in kept]
        self.texts = [k[1] for k in kept]
        self.hashes, self.starts = _ragged([k[2] for k in kept], np.uint64)
        self.need = [needed(len(k[2]), contained) for k in kept]
        self.contained = contained
        by_size: dict[int, list[int]] = defaultdict(list)
        for at, k in enumerate(kept):
            by_size[len(k[2]).bit_length()].append(at)
        self.classes = [SizeClass(own, [kept[i][2] for i in own], [self.need[i] for i in own]) for _, own in sorted(by_size.items())]

    def near(self, h: np.ndarray) -> np.ndarray:
        found = [c.near(h) for c in self.classes]
        return np.concatenate(found) if found else np.empty(0, dtype=np.int32)

    def matches(self, h: np.ndarray, data: bytes) -> list[tuple]:
        """(item, matched, shingles) of the items that a text with shingle hashes h contains."""
        out, words = [], None
        for i in self.near(h):
            at = np.flatnonzero(np.isin(h, self.hashes[self.starts[i] : self.starts[i + 1]]))
            if len(at) < self.need[i]:
                continue
            words = _words(data) if words is None else words
            own = _shingles(_words(self.texts[i]), self.words)
            found = {b" ".join(words[j : j + self.words]) for j in at} & own
            if len(found) >= needed(len(own), self.contained):
                out.append((self.ids[i], len(found), len(own)))
        return out


def _shingles(words: list[bytes], k: int) -> set[bytes]:
    return {b" ".join(words[j : j + k]) for j in range(len(words) - k + 1)}


def build(items: list[tuple], words: int = WORDS, contained: float = CONTAINED) -> Index:
    """The index of (id, text) items; items of fewer than `words` words are no evidence and stay out."""
    return Index(items, words, contained)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[Column]:
    """Predicates that part the items into blocks of about `block_bytes` of text."""
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    return [F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)) == b for b in range(n)] if n > 1 else [F.lit(True)]


def matcher(shared):
    @F.pandas_udf("array<struct<item_id:string,matched:long,shingles:long>>")
    def find(texts: pd.Series) -> pd.Series:
        index = shared.value
        found: list[list] = []
        for group in groups_of_texts(map(_bytes, texts)):
            for text, h in zip(group, hashed_texts(group, index.words, punctuation=True)):
                found.append([dict(zip(("item_id", "matched", "shingles"), m)) for m in index.matches(h, text)])
        return pd.Series(found)

    return find


def matchers(items: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = WORDS, contained: float = CONTAINED, block_bytes: int = BLOCK_BYTES) -> list:
    """A pandas UDF for each block of items: text to array<struct<item_id, matched, shingles>>."""
    spark = items.sparkSession
    small_batches(spark)
    out = []
    for block in item_blocks(items, id_col, text_col, block_bytes):
        rows = items.filter(block).select(F.col(id_col).cast("string"), F.col(text_col)).collect()  # about block_bytes
        shared = spark.sparkContext.broadcast(build([tuple(r) for r in rows], words, contained))

        out.append(matcher(shared))
    return out


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, contained: float = CONTAINED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and item that it contains: doc_id, item_id, matched, shingles, containment.

    Words are runs of letters, marks and digits in lower case; shingles are distinct
    runs of `words` words; a document contains an item if it holds a share of at
    least `contained` of the item's shingles, wherever they stand.  Items with
    fewer words than that, null ones too, match nothing; documents without text
    neither.  Equal items match each under their id; repeated documents give
    repeated rows; an empty table on either side gives none.  Ids may be of any
    type that text tells apart.  Other columns are not looked at.
    """
    out = None
    for find in matchers(items, words=words, contained=contained, block_bytes=block_bytes):
        found = docs.select(F.col(id_col).alias("doc_id"), F.explode(find(F.col(text_col))).alias("m"))
        found = found.select("doc_id", F.col("m.item_id").cast(items.schema["item_id"].dataType).alias("item_id"), "m.matched", "m.shingles", (F.col("m.matched") / F.col("m.shingles")).alias("containment"))
        out = found if out is None else out.unionByName(found)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that contain no item, with all their columns; nothing shuffles.

    What an item is and what contains it is as in contained_items().  Rows
    without text stay, as they contain nothing; very long texts are searched
    whole; repeated rows go or stay alike; an empty table gives none and an empty
    table of items leaves all; columns may have any name.
    """
    for find in matchers(items, **how):
        docs = docs.filter(F.size(find(F.col(text_col))) == 0)
    return docs
