"""The relation vocabulary and the textual cues of relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Label, code, category, in the type list, in the extraction list.
RELATIONS = (
    ("상위조항", "PARENT_ARTICLE", "structure", True, True),
    ("참조함", "REFERS_TO", "structure", True, True),
    ("준용함", "APPLIES_MUTATIS_MUTANDIS", "structure", True, True),
    ("위임함", "DELEGATES_TO", "structure", True, True),
    ("예외로함", "EXCEPTION_TO", "logic", True, True),
    ("우선함", "SUPERSEDES", "logic", True, True),
    ("근거함", "BASED_ON", "logic", True, True),
    ("정의함", "DEFINES", "action", True, True),
    ("요구함", "REQUIRES", "action", True, True),
    ("금지함", "PROHIBITS", "action", True, True),
    ("허용함", "ALLOWS", "action", True, True),
    ("처벌대상임", "PUNISHMENT_FOR", "sanction", True, True),
    ("과태료대상임", "PENALTY_FOR", "sanction", True, True),
    ("책임이있음", "RESPONSIBLE_FOR", "sanction", True, False),
    ("권한을가짐", "HAS_AUTHORITY", "procedure", True, True),
    ("적용대상임", "APPLIES_TO", "procedure", True, False),
    ("절차를따름", "FOLLOWS_PROCEDURE", "procedure", True, False),
    ("간주함", None, "logic", False, True),
    ("추정함", None, "logic", False, True),
    ("승인을요구함", None, "action", False, True),
    ("면제함", None, "sanction", False, True),
    ("가중함", None, "sanction", False, True),
)

# Relation and the wording that shows it.
CUES = (
    ("간주함", "로 본다"),
    ("추정함", "로 추정한다"),
    ("요구함", "(?:해야|하여야) 한다"),
    ("금지함", "(?:해서는|하여서는) 아니 된다"),
    ("허용함", "할 수 있다"),
    ("처벌대상임", "징역|벌금"),
    ("과태료대상임", "과태료"),
    ("위임함", "시행령|시행규칙|고시|대통령령"),
)


def relation_types(spark: SparkSession) -> DataFrame:
    """The dimension of relation labels; a fixed 22 rows, so fit to broadcast."""
    return spark.createDataFrame(RELATIONS, "label string, code string, category string, in_enum boolean, in_prompt boolean")


#: All cues at once.  None can begin inside another of a different relation, so matches that do not overlap are all.
_ANY_CUE = "|".join(f"(?:{cue})" for _, cue in CUES)


def cue_relations(text: Column) -> Column:
    """array<struct<relation, cue>> of the relations whose wording occurs; cue is its first occurrence.

    The text is gone through once; what was found tells its relation.
    """
    cues = F.regexp_extract_all(text, F.lit(_ANY_CUE), F.lit(0))

    def relation(cue: Column) -> Column:
        out = F.lit(None).cast("string")
        for label, pattern in CUES:
            out = F.when(cue.rlike(f"^(?:{pattern})$"), label).otherwise(out)
        return out

    each = F.transform(cues, lambda cue: F.struct(relation(cue).alias("relation"), cue.alias("cue")))
    # Seen through a lambda's variable, as what is repeated inside a lambda is computed again.
    return _once(each, lambda found: F.filter(found, lambda x, i: ~F.exists(F.slice(found, F.lit(1), i), lambda y: y["relation"] == x["relation"])))


def _once(value: Column, f) -> Column:
    """`f` of a value that is computed once, however often `f` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)
