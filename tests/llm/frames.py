"""Small tables with the awkward cases every operator has to stand."""

LONG = " ".join(f"word{i % 997} of" for i in range(60_000))
#: Names that operators use inside or return; as extra columns they must not matter.
CLASHING = "id h sha again keep_id kept size fp first root component_id component rank _rank _part _row shard slot curve doc source_size target taken positions position copy held_out lang_pred score ambiguous s bands text_sha256 group_size host path rule verdict url_ __keep record_type payload".split()


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return with_clashes(df) if clashing else df


def with_clashes(df):
    from pyspark.sql import functions as F

    have = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit(f"x-{c}").alias(c) for c in CLASHING if c not in have))


AWKWARD = [
    (1, "the cat sat on the mat and looked at the moon", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, LONG, "en", "b"),
    (5, "the cat sat on the mat and looked at the moon", "en", "b"),
    (6, " \t\n", None, "a"),
    (7, "é ü 漢字 😀 1234 !!!", "fr", None),
    (7, "é ü 漢字 😀 1234 !!!", "fr", None),
    (None, "no id here", "en", "c"),
    (9, "word", "en", "c"),
    (10, "12 34 !!", None, "c"),
]
