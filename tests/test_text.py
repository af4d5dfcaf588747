import random
import re

from pyspark.sql import functions as F

from statutegraph.functions import text as t
from statutegraph.operators import articles as art

SAMPLE = """제1조(목적) 이 법은 목적을 정한다.

제2조(정의) 용어의 뜻은 다음과 같다.
1. "개인정보"란 정보를 말한다.

제3조(원칙) ① 처리자는 제1조제2항에 따라 「상법」을 따라야 한다."""
PATTERN = re.compile(r"제\s*\d+\s*조(?:의\s*\d+)?(?:제\s*\d+\s*항)?")


def expected_split(text):
    """Pieces from one match to the next, as a plain loop."""
    starts = [m.start() for m in PATTERN.finditer(text)]
    if not starts:
        return [text]
    return [text[a:b].strip() for a, b in zip(starts, [*starts[1:], len(text)])]


def column(spark, values, c):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, content string")
    return [r[0] for r in rows.select("i", c(F.col("content")).alias("x")).orderBy("i").select("x").collect()]


def test_clean_text_treats_all_white_space_alike(spark):
    cases = ["  a \t\n b c　d\x1ce ", "", " ", None, "a"]
    assert column(spark, cases, t.clean_text) == ["a b c d e", "", "", None, "a"]


def test_split_by_hand(spark):
    cases = [SAMPLE, "없는 글 ", "", None, "머리 제１조 하나 제2조의3제4항둘", "제 5 조 가"]
    got = column(spark, cases, t.split_articles)
    assert got == [None if c is None else expected_split(c) for c in cases]
    assert len(got[0]) == 4 and got[1] == ["없는 글 "] and got[2] == [""]


def test_split_equals_the_loop_on_random_strings(spark):
    rng = random.Random(5)
    cases = ["".join(rng.choice("제조항의호12４ \n \x1d가(") for _ in range(rng.randrange(40))) for _ in range(2000)]
    assert column(spark, cases, t.split_articles) == [expected_split(c) for c in cases]


def test_rejoined_text_splits_into_the_same_pieces(spark):
    (once,) = column(spark, [SAMPLE], t.rejoin)
    assert expected_split(once) == expected_split(re.sub(r"\s+", " ", SAMPLE).strip())


def test_offsets_give_the_pieces_back(spark):
    docs = spark.createDataFrame([(1, "앞 " + SAMPLE), (2, "표지 없음"), (3, "")], "doc_id long, content string")
    text = {r.doc_id: r.content for r in docs.collect()}
    rows = sorted(map(tuple, art.offsets(docs).collect()))
    assert [text[d][a:b].strip() for d, _, a, b in rows if d == 1] == expected_split(text[1])
    assert [r for r in rows if r[0] > 1] == [(2, 0, 0, 5), (3, 0, 0, 0)]


def test_offsets_of_many_pieces_need_no_shuffle(spark):
    content = "".join(f"제{n}조 {'글' * (n % 7)} " for n in range(1, 1000))
    got = art.offsets(spark.createDataFrame([(1, content), (2, None)], "doc_id long, content string"))
    rows = sorted((r.pos, r.start, r.end) for r in got.collect())
    starts = [m.start() for m in re.finditer(r"제\d+조", content)]
    assert rows == list(zip(range(999), starts, [*starts[1:], len(content)]))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_numbers_titles_and_parts(spark):
    cases = ["제 2 조의3제 4항(뜻 풀이) 글", "제1조 글", "글"]
    assert column(spark, cases, t.article_number) == ["제2조의3제4항", "제1조", None]
    assert column(spark, cases, t.heading_title) == ["뜻 풀이", None, None]
    assert column(spark, ["제2조의3제4항", "제10조", "x"], t.number_parts) == [(2, 3, 4), (10, None, None), (None, None, None)]


def test_citations_stay_in_the_body(spark):
    (pieces,) = column(spark, [SAMPLE], lambda c: t.split_articles(c, "heading"))
    assert len(pieces) == 3
    assert column(spark, pieces, t.citations) == [[], [], ["제1조제2항"]]
    assert column(spark, pieces, t.law_mentions)[2] == ["상법"]
    assert column(spark, pieces, t.defined_terms)[1] == ["개인정보"]


def test_parents(spark):
    cases = ["제469조제2항제2호", "제5조의2", "제5조", "제5조의2제1항"]
    assert column(spark, cases, t.parent_number) == ["제469조제2항", "제5조", None, "제5조의2"]
    assert column(spark, cases, lambda c: t.parent_number(c, "article")) == ["제469조", None, None, "제5조의2"]


def test_or_default(spark):
    assert column(spark, [None, "", "x"], lambda c: t.or_default(c, "-")) == ["-", "-", "x"]
