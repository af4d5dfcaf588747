import pytest
import pandas as pd
from pyspark.sql import functions as F

from statutegraph.operators import parse
from statutegraph.operators import score as scoring
from statutegraph.operators.score import score
from statutegraph.plans import corpus

GOOD = '{"subject":"s","relation":"r","object":"o","article_number":"제1조","confidence":0.5,"more":[1]}'


def item(confidence):
    return '{"subject":"s","relation":"r","object":"o","article_number":"제1조","confidence":%s}' % confidence


def answers(spark, texts):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, pos long, response string")


def confidences(spark, texts):
    got = {}
    for r in parse.triplets(answers(spark, texts)).collect():
        got.setdefault(r.pos, []).append(r.confidence)
    return [got.get(i, []) for i in range(len(texts))]


def test_items_of_lists_objects_and_nothing_else(spark):
    texts = [GOOD, f"[{GOOD},{GOOD}]", f'[{GOOD},"x",7,null]', "[]", "3", '"x"', "null", "no", "", f"```json\n[{GOOD}]\n```", f"```\n{GOOD}```", None]
    assert [len(c) for c in confidences(spark, texts)] == [1, 2, 1, 0, 0, 0, 0, 0, 0, 1, 1, 0]


def test_confidence_missing_null_text_and_truth(spark):
    missing = '{"subject":"s","relation":"r","object":"o","article_number":"제1조"}'
    texts = [missing, item("null"), item('"0.9"'), item("true"), item('"high"'), item("1"), item("[1]")]
    assert confidences(spark, texts) == [[1.0], [], [0.9], [1.0], [], [1.0], []]


def test_text_fields_must_be_text(spark):
    texts = [GOOD.replace('"s"', "5"), GOOD.replace('"o"', "null"), GOOD.replace('"subject":"s",', ""), GOOD]
    assert [len(c) for c in confidences(spark, texts)] == [0, 0, 0, 1]


def test_errors_name_the_stage(spark):
    rows = answers(spark, ["no", f'[{GOOD},"x"]', GOOD])
    lost = spark.createDataFrame([(1, 2, "제9조")], "doc_id long, pos long, article_number string")
    got = {(r.stage, r.message): r.errors for r in parse.error_summary(parse.errors(rows, lost)).collect()}
    assert got == {("parse", "no JSON"): 1, ("validate", "invalid item"): 1, ("match", "no article 제9조"): 1}


def test_entities_always_one_row(spark):
    good = '{"article_number":"제1조","concept":"목적","subject":null,"full_text":"글"}'
    texts = [good, f"[{good},1]", good.replace("null", "4"), good.replace('"목적"', "null"), "[]", "x", None, '{"article_number":"제1조"}']
    rows = spark.createDataFrame([(1, i, f"본문{i}", t) for i, t in enumerate(texts)], "doc_id long, pos long, article_text string, response string")
    got = {r.pos: (r.article_number, r.concept, r.subject, r.full_text) for r in parse.entities(rows).collect()}
    assert got[0] == got[1] == ("제1조", "목적", None, "글")
    assert all(got[i] == ("Unknown", "Unknown", None, f"본문{i}") for i in range(2, 8))
    (q,) = parse.quality(parse.entities(rows)).collect()
    assert (q.records, q.defaults, q.malformed) == (8, 6, 6)


def test_score_asks_equal_prompts_once_and_isolates_failures(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(prompts: pd.Series) -> pd.Series:
        if (prompts == "bad").any():
            raise ValueError("no")
        calls.add(len(prompts))
        return prompts + "!"

    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, "b"), (5, None)], "i long, prompt string")
    got = {r.i: r.response for r in score(rows, "prompt", fn, partitions=1).collect()}
    assert got == {1: "a!", 2: "a!", 3: None, 4: "b!", 5: None}
    assert calls.value == 2
    assert score(rows.filter(F.lit(False)), "prompt", fn).count() == 0


@pytest.mark.parametrize(
    ("answer", "why"),
    [
        (lambda s: s.iloc[:-1], "1 answers to 2 prompts"),
        (lambda s: [*s, "more"], "answers to"),
        (lambda s: s.set_axis(range(10, 10 + len(s))), None),
        (lambda s: s.str.len(), "no string but int"),
        (lambda s: pd.Series([None] * len(s)), "no answer"),
    ],
)
def test_score_loses_no_answer_in_silence(spark, answer, why):
    """Too few, too many, another index, no strings, none."""
    rows = spark.createDataFrame([(i, f"p{i % 2}") for i in range(4)] + [(9, None)], "i long, prompt string").coalesce(1)
    got = score(rows, "prompt", lambda s: answer("A" + s), error="why", partitions=1).collect()
    assert len(got) == 5
    for r in got:
        if r.i == 9:
            assert r.response is None and r.why is None
        elif why is None:
            assert r.response == f"Ap{r.i % 2}" and r.why is None
        elif why.startswith("1 answers"):
            assert r.response is None and "0 answers to 1 prompts" in r.why
        else:
            assert r.response is None and why in r.why


def test_score_remembers_answers_and_asks_failures_again_up_to_a_bound(spark, tmp_path):
    memory = str(tmp_path / "memory")

    def fn(prompts):
        if prompts.str.contains("bad").any():
            raise ValueError("refused")
        return "A" + prompts

    rows = lambda *p: spark.createDataFrame([(x,) for x in p], "prompt string")
    run = lambda name, *p: {r.prompt: (r.response, r.why) for r in score(rows(*p), "prompt", fn, error="why", memory=memory, attempts=2, run=name).collect()}
    asked = lambda name: spark.read.parquet(memory).filter(F.col("run") == name).count()
    assert run("1", "a", "a", "b", "bad") == {"a": ("Aa", None), "b": ("Ab", None), "bad": (None, "ValueError: refused")}
    assert run("2", "a", "b", "bad", "c") == {"a": ("Aa", None), "b": ("Ab", None), "bad": (None, "ValueError: refused"), "c": ("Ac", None)}
    assert run("3", "a", "bad") == {"a": ("Aa", None), "bad": (None, "ValueError: refused")}
    assert [asked(n) for n in "123"] == [3, 2, 0]


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_errors_read_the_answers_once(spark, tmp_path):
    path = str(tmp_path / "answers")
    spark.createDataFrame([(1, 0, "{", None), (1, 1, None, "refused"), (1, 2, "[1]", "late"), (1, 3, "[]", None)], "doc_id long, pos long, response string, error string").write.parquet(path)
    found = parse.errors(spark.read.parquet(path))
    assert _plan(found).split("== Physical Plan ==")[1].count("FileScan") == 1
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, "parse", "no JSON"), (1, 1, "extract", "refused"), (1, 2, "extract", "late")]


def test_second_prompts_are_made_once(spark):
    docs = spark.createDataFrame([(1, "제1조 가 제2조 나")], "doc_id long, content string")
    entity = lambda s: pd.Series(['{"article_number": "제1조", "concept": "c", "full_text": "f"}'] * len(s))
    _, triplets, errors = corpus.scored(docs, entity, lambda s: pd.Series(["{"] * len(s)))
    assert "Window" not in _plan(triplets) and "Window" not in _plan(errors)
    assert triplets.count() == 0 and errors.count() == 2


def test_prompts_move_once_to_their_digest(spark, tmp_path, monkeypatch):
    plans, asked = [], scoring._asked
    monkeypatch.setattr(scoring, "_asked", lambda prompts, *more: plans.append(_plan(prompts)) or asked(prompts, *more))
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "prompt string")
    got = scoring.score(rows, "prompt", lambda s: "A" + s, memory=str(tmp_path / "memory"))
    assert sorted(r.response for r in got.collect()) == ["Aa", "Aa", "Ab"]
    assert "hashpartitioning(sha" in plans[0] and "hashpartitioning(_prompt" not in plans[0]
