"""Chat formatting with a grammar that gives the turns back.

    conversation := turn*
    turn         := "### " role ": " body "</turn>" newline

A backslash takes the next character literally.  A text (or role) that the
grammar would not give back as it is is escaped: backslashes, the hashes of
``###`` and the slash of ``</turn>`` (in roles colons too).  The parser
splits at unescaped ends of turns and reads role and body of each piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("###"), F.lit("\\#\\#\\#"))
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), role, F.lit(": "), body, F.lit(END))


#: A role ends at the first colon that no backslash takes; the body is the rest.
_TURN = r"(?s)^### ([^\\:]*(?:\\.[^\\:]*)*): (.*)$"


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text, head, body>>: the turns that the grammar finds; head and body as rendered."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(p: Column) -> Column:
        head, body = F.regexp_extract(p, _TURN, 1), F.regexp_extract(p, _TURN, 2)
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"), head.alias("head"), body.alias("body"))

    return F.transform(pieces, turn)


def turns_only(parsed: Column) -> Column:
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def render_safe(turns: Column) -> Column:
    """The conversation's text: each turn plain if that parses back to itself, else escaped."""

    def one(t: Column) -> Column:
        plain = render_turn(t["role"], t["text"])
        same = turns_only(parse_turns(plain)) == F.array(F.struct(t["role"].alias("role"), t["text"].alias("text")))
        # A text may hold no part of the grammar at all: it could join with what stands next to it.
        clean = same & ~F.contains(t["text"], F.lit("###")) & ~F.contains(t["text"], F.lit("</turn>")) & ~F.contains(t["role"], F.lit("#"))
        return F.when(clean, plain).otherwise(render_turn(escape_role(t["role"]), escape(t["text"])))

    return F.concat_ws("", F.transform(turns, one))


def render_escaped(turns: Column) -> Column:
    """Every turn escaped, whether it needs to be or not."""
    return F.concat_ws("", F.transform(turns, lambda t: render_turn(escape_role(t["role"]), escape(t["text"]))))


def chunks_of(items: Column) -> Column:
    """An array in about as many runs as each run has items: what grows with a run or with their number stays small."""
    n = F.size(items)
    run = F.greatest(F.lit(1), F.ceil(F.sqrt(n))).cast("int")
    return F.transform(F.filter(F.sequence(F.lit(0), n, run), lambda at: at < n), lambda at: F.slice(items, at + 1, run))


def spans_of(parsed: Column) -> Column:
    """(start, length) of the assistant bodies, in code points: "### ", role and ": " stand before each."""
    head = lambda t: F.length(t["head"]) + F.lit(len("### : "))
    width = lambda t: head(t) + F.length(t["body"]) + F.lit(len(END))
    none = F.array().cast("array<struct<start:int,length:int>>")
    chunks = chunks_of(parsed)
    widths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, t: acc + width(t)))
    starts = F.aggregate(widths, F.array(F.lit(0)), lambda acc, w: F.concat(acc, F.array(F.element_at(acc, -1) + w)))

    def walk(chunk: Column, i: Column) -> Column:
        def step(acc: Column, t: Column) -> Column:
            own = F.array(F.struct((acc["at"] + head(t)).alias("start"), F.length(t["body"]).alias("length")))
            return F.struct((acc["at"] + width(t)).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(chunk, F.struct(F.get(starts, i).alias("at"), none.alias("spans")), step)["spans"]

    return F.flatten(F.transform(chunks, walk))


def under_spans(text: Column, spans: Column) -> Column:
    """The text under each span, a run of spans being cut from the text at once."""

    def cut(chunk: Column) -> Column:
        first, last = F.element_at(chunk, 1), F.element_at(chunk, -1)
        piece = F.substring(text, first["start"] + 1, last["start"] + last["length"] - first["start"])
        return F.transform(chunk, lambda s: F.substring(piece, s["start"] - first["start"] + 1, s["length"]))

    return F.flatten(F.transform(chunks_of(spans), cut))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each conversation: conv_id, formatted, loss_spans, n_turns, identical.

    Rows of a conversation follow by turn (nulls first), ties by role and text;
    repeated rows are turns of their own; null roles and texts count as empty; a
    null conv_id is one conversation; very long texts and conversations are
    formatted whole; an empty table gives none.  `loss_spans` are the (start,
    length) of the assistant bodies in `formatted`, from 0, in code points.  The
    text is parsed and compared with the source; where a turn did not come back,
    all are escaped, and `identical` tells whether parsing then gave back every
    turn.  A conversation is one value and so has to fit a row.  Other columns are
    not looked at.  No Python runs on the executors.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    out = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    same = turns_only(F.col("_turns")) == turns_only(F.col("_parsed"))
    # Each step is a projection of its own, so that no expression is copied into the next.
    out = out.withColumn("formatted", render_safe(F.col("_turns")))
    out = out.withColumn("_parsed", parse_turns(F.col("formatted"))).withColumn("_same", same)
    out = out.withColumn("formatted", F.when(F.col("_same"), F.col("formatted")).otherwise(render_escaped(F.col("_turns"))))
    out = out.withColumn("_parsed", F.when(F.col("_same"), F.col("_parsed")).otherwise(parse_turns(F.col("formatted"))))
    return out.select("conv_id", "formatted", spans_of(F.col("_parsed")).alias("loss_spans"), F.size("_parsed").cast("long").alias("n_turns"), (F.col("_same") | same).alias("identical"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text alone gives back: turns, and the text under the loss mask.

    A conversation that parsing does not give back is an error.
    """
    text = F.when(F.col("identical"), F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not parse back to itself")))
    out = formatted.select("conv_id", text.alias("formatted"), "loss_spans")
    out = out.withColumn("_parsed", parse_turns(F.col("formatted")))
    out = out.withColumn("_loss", F.concat_ws("", F.transform(under_spans(F.col("formatted"), F.col("loss_spans")), unescape)))
    turns = F.concat_ws("", F.transform("_parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        F.size("_parsed").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
