"""Language identification with error-correcting output codes.

Each language gets a codeword of bits.  A linear classifier on hashed byte
n-grams predicts each bit; the language whose codeword has the least loss,
bits weighted by their reliability, is chosen, and a close second flags the
text as ambiguous.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import fresh, small_batches

FEATURES = 1 << 12
#: Documents learnt from for each language, at most, and for all languages together; chosen
#: by a hash of id and text.  With LEAST_DOCS a language the sum bounds what comes to the driver.
TRAIN_DOCS = 400
TRAIN_TOTAL = 6000
LEAST_DOCS = 20
#: Labels learned, at most.
MOST_LANGUAGES = 1000
MAX_BITS = 31
RIDGE = 3.0
#: The second best is ambiguous if it is less likely by less than this.
AMBIGUOUS = 0.05
#: Loss of a text that says nothing of any bit.  One with as much against its nearest codeword is in no language learnt.
NO_EVIDENCE = 1.0
#: Bytes of a text whose n-grams are counted at once.
CHUNK = 1 << 20

_LETTER = regex.compile(r"\p{L}")


def _byte_table() -> np.ndarray:
    """ASCII letters in lower case, bytes of other characters as they are, everything else a space."""
    t = np.arange(256, dtype=np.uint32)
    t[:128] = 0x20
    for c in range(ord("a"), ord("z") + 1):
        t[c] = t[c - 32] = c
    return t


_BYTES = _byte_table()


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1-, 2- and 3-grams of all bytes of a text, as shares."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    out = np.zeros(FEATURES, dtype=np.float64)
    for at in range(0, max(1, len(data)), CHUNK):
        x = _BYTES[data[max(0, at - 2) : at + CHUNK]]  # two bytes again: n-grams across the cut
        skip = min(at, 2)
        for n in (1, 2, 3):
            if len(x) < n:
                continue
            code = np.full(len(x) - n + 1, np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF), dtype=np.uint32)
            for j in range(n):
                code = (code ^ x[j : len(x) - n + 1 + j]) * np.uint32(0x01000193)
            code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out += np.bincount((code >> np.uint32(20))[max(0, skip - n + 1) :], minlength=FEATURES)
    total = out.sum()
    return np.sqrt(out / total) if total else out


def codewords(classes: int, max_bits: int = MAX_BITS, seed: int = 7) -> np.ndarray:
    """classes x bits of +1 and -1: all splits of up to 6 classes, else random splits, no two alike."""
    if classes <= 6:
        splits = [s for s in itertools.product((1, -1), repeat=classes) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.float64).T.reshape(classes, -1)
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(64):  # of so many random codes the one whose closest words are the farthest apart
        code = rng.choice((1.0, -1.0), size=(classes, max_bits))
        near = min((code[i] != code[j]).sum() for i in range(classes) for j in range(i))
        if near > apart and (np.abs(code.sum(axis=0)) < classes).all():
            best, apart = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # FEATURES + 1 x bits; the last row is the bias
    reliable: np.ndarray  # weight of each bit

    def losses(self, x: np.ndarray) -> np.ndarray:
        margins = x @ self.weights[:-1] + self.weights[-1]
        return np.array([(self.reliable * np.maximum(0.0, 1.0 - word * margins)).sum() for word in self.code])

    def predict(self, text: str | None) -> tuple[str, float, bool, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return "und", 0.0, False, NO_EVIDENCE
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False, 0.0
        losses = self.losses(ngram_counts(text))
        shares = np.exp(4.0 * (losses.min() - losses))
        shares /= shares.sum()
        first, second = np.argsort(-shares, kind="stable")[:2]
        return self.languages[first], float(min(1.0, shares[first])), bool(shares[first] - shares[second] < AMBIGUOUS), float(losses.min())


def train(languages: list[str], x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge regression of every bit on the features, by its dual where there are fewer rows than features."""
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((len(languages), 1))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((FEATURES + 1, code.shape[1])), np.ones(code.shape[1]))
    mean = x.mean(axis=0)
    centred, target = x - mean, code[y]
    rare = 1.0 / np.bincount(y, minlength=len(languages))[y]  # languages count alike, whatever their rows
    rare = np.sqrt(rare / rare.mean())[:, None]
    base = (rare * rare * target).mean(axis=0) / (rare * rare).mean()
    a, b = rare * centred, rare * (target - base)
    ridge = RIDGE * 1e-3 * max((a * a).sum() / len(a), 1e-12)
    if len(a) <= a.shape[1]:
        weights = a.T @ np.linalg.solve(a @ a.T + ridge * np.eye(len(a)), b)
    else:
        weights = np.linalg.solve(a.T @ a + ridge * np.eye(a.shape[1]), a.T @ b)
    bias = base - mean @ weights
    wrong = (np.sign(x @ weights + bias) != target).mean(axis=0)
    wrong = (wrong * len(x) + 1) / (len(x) + 2)
    reliable = np.maximum(np.log((1 - wrong) / wrong), 0.05)
    return Model(languages, code, np.vstack([weights, bias]), reliable / reliable.sum())


def is_held_out(id_text):
    """The held-out quarter: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_text.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(train_docs: int):
    """The rows of the smallest draws, at most `train_docs` of a language in a task, as sparse n-gram counts of their whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, list] = {}
        for b in batches:
            for lang, text, i, draw in zip(b["lang"], b["text"], b["id"], b["draw"]):
                if not _LETTER.search(text):
                    continue
                held = best.setdefault(lang, [])
                if len(held) == train_docs and -draw <= held[0][0]:
                    continue
                x = ngram_counts(text).astype(np.float32)
                at = np.flatnonzero(x).astype(np.uint16)
                (heapq.heappush if len(held) < train_docs else heapq.heapreplace)(held, (-draw, "" if i is None else i, at.tobytes(), x[at].tobytes()))
        rows = [(lang, i, -draw, at, x) for lang, held in best.items() for draw, i, at, x in held]
        yield pd.DataFrame(rows, columns=["lang", "id", "draw", "at", "x"])

    return run


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
    train_total: int = TRAIN_TOTAL,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Learn from at most `train_docs` rows of each language, about `train_total` of all, outside the held-out quarter.

    Rows are chosen by the smallest hashes of id and text, so that reruns agree,
    and no more than that many, whatever ids and texts repeat.  Of more than
    `most_languages` labels the most frequent are learned.  Sparse n-gram counts of
    the chosen rows, of their whole texts, are all that comes to the driver; it solves
    for the smaller of rows and features, so that its memory does not grow with the
    languages.  Ids may be of any type, null ones too.  Rows without text, letter or
    label teach nothing; without any labelled row the model knows no language.
    """
    small_batches(docs.sparkSession)
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("id")))
    labels = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not labels:
        return Model([], np.ones((0, 1)), np.zeros((FEATURES + 1, 1)), np.ones(1))
    train_docs = min(train_docs, max(LEAST_DOCS, train_total // len(labels)))
    share = F.create_map(*itertools.chain.from_iterable((F.lit(r["lang"]), F.lit(min(1.0, 1.5 * train_docs / r["n"]))) for r in labels))
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.withColumn("draw", draw).filter(F.col("draw") < F.element_at(share, F.col("lang")))
    rows = chosen.mapInPandas(_sample(train_docs), "lang string, id string, draw double, at binary, x binary")
    place = F.row_number().over(W.partitionBy("lang").orderBy("draw", "id", "at", "x"))
    rows = rows.withColumn("_place", place).filter(F.col("_place") <= train_docs).drop("_place").collect()  # train_docs for each of most_languages
    rows = sorted(rows, key=lambda r: (r["lang"], r["id"], bytes(r["at"]), bytes(r["x"])))
    languages = sorted({r["lang"] for r in rows})
    x = np.zeros((len(rows), FEATURES))
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], dtype=np.uint16)] = np.frombuffer(r["x"], dtype=np.float32)
    y = np.array([languages.index(r["lang"]) for r in rows], dtype=np.int64)
    return train(languages, x, y)


def predict_column(spark, model: Model):
    """A pandas UDF: text to struct<lang_pred, score, ambiguous, loss>."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES x at most MAX_BITS numbers

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, loss double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous", "loss"])

    return predict


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous, loss for every row.

    A null text, or one without a letter, is `und` with score 0; so is everything
    where the model knows no language.  The prediction sees the text alone, all
    of it.  Repeated rows give the same; a null id is not held out; an empty
    table gives none; other columns are not looked at.
    """
    predict = predict_column(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), predict(F.col(text_col)).alias("_p"))
    return rows.select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.ambiguous", "_p.loss")


def in_a_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is in a language that the model knows, with all their columns.

    Texts without a letter go, null and empty ones too, and texts whose nearest
    codeword has as much against it as one of which nothing is known; ambiguous
    ones stay.  Very long texts are looked at whole; repeated rows are judged
    alike; an empty table gives none.  A model that knows no language judges by
    letters alone.
    """
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_col), F.lit("")).rlike(r"\p{L}"))
    predict = predict_column(docs.sparkSession, model)
    (at,) = fresh(docs, "language")
    judged = docs.withColumn(at, predict(F.col(text_col)))
    return judged.filter((F.col(at)["lang_pred"] != "und") & (F.col(at)["loss"] < NO_EVIDENCE)).select(docs.columns)
