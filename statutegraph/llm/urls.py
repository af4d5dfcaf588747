"""URL filtering: host rules, then a weighted vocabulary found by Aho-Corasick.

A vocabulary gives terms weights, and a url is rejected when the weights of its
distinct terms reach a threshold: one strict term does alone, of soft ones
several are needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): host and path of a rule as one string.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: One of these is enough.
STRICT = ("casino", "porn", "xxx", "viagra", "warez", "spam", "pills", "adult")
#: Of these so many distinct ones are.
SOFT = ("free", "cheap", "win", "bets", "ads", "track", "bonus", "deal", "click", "promo")
SOFT_NEEDED = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WITHIN = frozenset(f"{_LOWER}0123456789")


def vocabulary(strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_needed: int = SOFT_NEEDED) -> dict[str, int]:
    """Weights of terms: strict ones reach the threshold, `soft_needed`, alone; soft ones have 1.  A term of both is strict."""
    return {t.lower(): 1 for t in soft} | {t.lower(): soft_needed for t in strict}


def vocabulary_of(terms: DataFrame, term_col: str = "term", weight_col: str = "weight", max_terms: int = 1_000_000) -> dict[str, int]:
    """A vocabulary from a table, which goes to each task and so has a bound; of a repeated term the largest weight."""
    rows = terms.filter(F.col(term_col) != "").groupBy(F.lower(term_col).alias("t")).agg(F.max(weight_col).cast("int").alias("w")).limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"more than {max_terms} terms")
    return {r["t"]: r["w"] for r in rows}


class Terms:
    """Hits of a vocabulary in many urls at once."""

    def __init__(self, weights: dict[str, int]):
        self.found = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.found.add_word(term, (term, weight))
        self.found.make_automaton()
        self.any = bool(weights)

    def hits(self, urls: list[str], threshold: int) -> pd.DataFrame:
        """strict and soft: distinct terms of each url that stand between boundaries, and the sum of their weights.

        A boundary is an end, or anything but an ASCII letter or digit.  The urls,
        in lower case, are searched as one text, with a sign between them that no
        term may cross.
        """
        text = "\n".join(urls)
        ends = np.cumsum([len(u) + 1 for u in urls])
        at, terms, weights = [], [], []
        for end, (term, weight) in self.found.iter(text) if self.any else ():
            start = end - len(term) + 1
            if not ((start and text[start - 1] in _WITHIN) or text[end + 1 : end + 2] in _WITHIN or "\n" in term):
                at.append(end)
                terms.append(term)
                weights.append(weight)
        rows = pd.DataFrame({"row": np.searchsorted(ends, at, side="right"), "term": terms, "weight": weights}).drop_duplicates(["row", "term"])
        strict = rows["weight"] >= threshold
        sums = [rows[strict].groupby("row").size(), rows[~strict].groupby("row").size(), rows.groupby("row")["weight"].sum()]
        out = pd.DataFrame(dict(zip(("strict", "soft", "weight"), sums)))
        return out.reindex(range(len(urls))).fillna(0).astype("int32")


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    terms: dict[str, int] | None = None,
    threshold: int = SOFT_NEEDED,
) -> DataFrame:
    """A verdict for each row: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: then up to ``?``, ``#`` or the end.  A null url and one
    without ``://`` have empty ones.  A rule fits its host and all subdomains
    where the path starts with the rule's; the longest decides (of equally long
    ones the smaller by code point).  Where none fits, distinct
    terms anywhere in the url whose weights sum to `threshold` block it: one
    strict term, of that weight or more, or several soft ones.  A null url is
    allowed, very long ones are searched whole.  Rows that repeat are judged
    alike; an empty table gives none; other columns are not looked at.  Rules and
    terms are parameters and go to each task; terms with a line break match nothing.
    """
    terms = vocabulary() if terms is None else terms
    u = F.coalesce(F.col(url_col), F.lit(""))
    host = F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col(id_col).alias("page_id"), F.translate(host, _UPPER, _LOWER).alias("host"), path.alias("path"), F.translate(u, _UPPER, _LOWER).alias("url"))
    rule = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for name, kind in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):  # later ones stand above
        at = name.index("/") if "/" in name else len(name)
        fits = ((F.col("host") == name[:at]) | F.endswith("host", F.lit("." + name[:at]))) & F.startswith("path", F.lit(name[at:]))
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, kind).otherwise(verdict)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = Terms(terms)
        for urls in batches:
            yield found.hits(urls.tolist(), threshold)

    counted = F.pandas_udf(count, "strict int, soft int, weight int")
    rows = rows.withColumns({"rule": rule, "_by_rule": verdict, "_hits": counted(F.col("url"))})
    by_terms = F.when(F.col("_hits.weight") >= threshold, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("_by_rule", by_terms).alias("verdict"), F.col("_hits.strict").alias("strict_hits"), F.col("_hits.soft").alias("soft_hits"))
