"""Column functions on statute text.  All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods see it: Java's Unicode class and four separators.
SPACE = r"[\s\x1c-\x1f]"
#: The same characters, one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# The article marker 제N조[의N][제N항].
ARTICLE = rf"제{SPACE}*\d+{SPACE}*조(?:의{SPACE}*\d+)?(?:제{SPACE}*\d+{SPACE}*항)?"
ITEM = rf"(?:제{SPACE}*\d+{SPACE}*호)?"
UNICODE = "(?U)"

UNKNOWN = "Unknown"
NOT_GIVEN = "N/A"
DASH = "-"
NO_CONTEXT = "없음"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))  # looks at the ends only


def clean_text(c: Column) -> Column:
    """Every run of white space, no-break spaces too, as one space; none at the ends."""
    # A single space, the commonest run by far, is left as it is.
    return F.trim(F.regexp_replace(c, rf"{UNICODE}[\s\x1c-\x1f&&[^ ]]{SPACE}*| {SPACE}+", " "))


def or_default(c: Column, default: str) -> Column:
    """`default` for null and for the empty string."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def raw_pieces(c: Column, mode: str = "citation") -> Column:
    """The text cut before each article marker; what stands before the first is the first piece.

    mode="citation" cuts at every marker; "heading" only where a title in
    parentheses follows the marker.
    """
    return F.split(c, f"{UNICODE}(?={_start(mode)})")


def _start(mode: str) -> str:
    if mode not in ("citation", "heading"):
        raise ValueError(f"mode is citation or heading, not {mode!r}")
    return ARTICLE if mode == "citation" else rf"{ARTICLE}{SPACE}*\("


def begins_article(c: Column, mode: str = "citation") -> Column:
    return c.rlike(f"{UNICODE}^{_start(mode)}")


def split_articles(c: Column, mode: str = "citation") -> Column:
    """The articles of a text, stripped, in order; without any marker the text as it is.

    What stands before the first marker is dropped.  A null text gives null.
    """
    articles = F.transform(F.filter(raw_pieces(c, mode), lambda p: begins_article(p, mode)), strip)
    return F.when(c.rlike(f"{UNICODE}{_start(mode)}"), articles).otherwise(F.when(c.isNotNull(), F.array(c)))


def rejoin(c: Column) -> Column:
    """Cleaned, split, and joined again with blank lines."""
    return F.concat_ws("\n\n", split_articles(clean_text(c)))


def _no_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"{UNICODE}{SPACE}+", "")


def article_number(c: Column) -> Column:
    """The marker that a piece begins with, without white space; null if there is none."""
    return F.nullif(_no_space(F.regexp_extract(c, f"{UNICODE}^({ARTICLE})", 1)), F.lit(""))


def number_parts(number: Column) -> Column:
    """struct<article, branch, para> of a marker without white space; null parts where it has none."""

    def part(pattern: str) -> Column:
        return F.regexp_extract(number, f"{UNICODE}{pattern}", 1).try_cast("int")

    return F.struct(part(r"제(\d+)조").alias("article"), part(r"조의(\d+)").alias("branch"), part(r"제(\d+)항").alias("para"))


def heading_title(c: Column) -> Column:
    """The title in parentheses after the marker; null if there is none."""
    return F.nullif(F.regexp_extract(c, rf"{UNICODE}^{ARTICLE}{SPACE}*\(([^)]*)\)", 1), F.lit(""))


def body(c: Column) -> Column:
    """A piece without its marker and title."""
    return F.regexp_replace(c, rf"{UNICODE}^{ARTICLE}{SPACE}*(?:\([^)]*\))?", "")


def citations(c: Column) -> Column:
    """Every article cited in the body of a piece, without white space, in order."""
    return F.transform(F.regexp_extract_all(body(c), F.lit(f"{UNICODE}{ARTICLE}{ITEM}"), F.lit(0)), _no_space)


def law_mentions(c: Column) -> Column:
    """Names of other statutes, in corner brackets."""
    return F.regexp_extract_all(c, F.lit("「([^」]+)」"), F.lit(1))


def defined_terms(c: Column) -> Column:
    """Terms that the text defines: quoted, then 란 or 이란."""
    return F.regexp_extract_all(c, F.lit('["“]([^"”]+)["”]\\s*(?:이)?란'), F.lit(1))


def parent_number(c: Column, level: str = "part") -> Column:
    """A citation without its last part (호, 항, 의N); at level "article" just 제N조[의N].

    A plain 제N조 has no parent: null.
    """
    if level == "article":
        up = F.regexp_extract(c, rf"{UNICODE}^(제\d+조(?:의\d+)?)", 1)
        return F.when(up != c, F.nullif(up, F.lit("")))
    up = F.regexp_replace(c, rf"{UNICODE}(?:제\d+호|제\d+항|(?<=조)의\d+)$", "")
    return F.when(up != c, up)


def law_citations(c: Column) -> Column:
    """The articles cited in the body of a piece, in order, each with the law whose name in 「」 stands nearest before it: array<struct<law, cited>>.

    A citation before any name has a null law: it is to the text's own statute.
    """
    tokens = F.regexp_extract_all(body(c), F.lit(f"{UNICODE}「[^」]+」|{ARTICLE}{ITEM}"), F.lit(0))
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("law"), F.array().cast("array<struct<law:string,cited:string>>").alias("found"))

    def step(a: Column, token: Column) -> Column:
        named = F.startswith(token, F.lit("「"))
        cited = F.struct(a["law"].alias("law"), _no_space(token).alias("cited"))
        law = F.when(named, F.regexp_replace(token, "[「」]", "")).otherwise(a["law"])
        return F.struct(law.alias("law"), F.when(named, a["found"]).otherwise(F.concat(a["found"], F.array(cited))).alias("found"))

    return F.aggregate(tokens, start, step, lambda a: a["found"])


def ancestors(c: Column) -> Column:
    """A citation and all that it is part of, the article last: array<string>."""
    up = [c]
    for _ in range(3):  # 호, 항, 의N
        up.append(parent_number(up[-1]))
    return F.filter(F.array(*up), lambda x: x.isNotNull())
