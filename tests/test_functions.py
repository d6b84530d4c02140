from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.functions import tables as T
from sparkquill.operators.chunking import Packer


def one(spark, schema, *values):
    return spark.createDataFrame([values], schema)


@pytest.mark.parametrize(
    ("text", "number"),
    [("1,234억원", 1234.0), ("12.3%", 12.3), ("없음", None), ("(801)", 801.0), ("1.철강 부문", 1.0), ("제22기", 22.0), ("１２３", 123.0), ("- 5", -5.0), ("", None), (None, None)],
)
def test_parse_number(spark, text, number):
    assert one(spark, "s string", text).select(S.parse_number(F.col("s"))).first()[0] == number


@pytest.mark.parametrize(
    ("predicted", "gold", "right"),
    [
        ("1,235", "1234", True), ("1300", "1234", False), ("반도체 사업부", "반도체사업부", True), ("디스플레이", "반도체", False),
        ("0.005", "0", True), ("0.01", "0", False), ("101", "100", True), (None, "1", False), ("", "1", False), ("ＡＢ　c", "ａｂC", True),
    ],
)
def test_grade(spark, predicted, gold, right):
    assert one(spark, "p string, g string", predicted, gold).select(S.grade(F.col("p"), F.col("g"))).first()[0] is right


def test_final_answer(spark):
    rows = [("x\n최종답: 12 억원 \n최종답： 13\n", "13"), ("one\n\n two \n", "two"), ("  \n", None), ("", None)]
    got = spark.createDataFrame(rows, "t string, want string").select(S.final_answer(F.col("t")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_headings(spark):
    df = one(spark, "a string, b string", "Ⅱ.  사업의   내용", "Ⅲ．재무에 관한 사항")
    r = df.select(S.normalize_heading(F.col("a")).alias("a"), S.normalize_heading(F.col("b")).alias("b"), S.heading_matches(F.col("a"), F.array(F.lit("사업의 내용"))).alias("m"), S.heading_kind(S.normalize_heading(F.col("b"))).alias("k")).first()
    assert (r.a, r.b, r.m, r.k) == ("II. 사업의 내용", "III.재무에 관한 사항", True, "top")


def test_small_scalars(spark):
    df = one(spark, "c string, n int, s string, h int", "1234567890", 7, "T1:1, T2:2", None)
    r = df.select(
        S.zfill(F.col("c"), 8).alias("z"), S.item_id(F.lit("T3"), F.col("n")).alias("i"), S.need_map(F.col("s")).alias("m"), S.difficulty_group(F.col("h")).alias("g"),
        S.clean_cell(F.lit(" a|b\n c ")).alias("cell"), S.report_year(F.lit("2023_A001")).alias("y"), S.report_year(F.lit("x")).alias("y0"), S.percent(F.lit(0.125)).alias("p"),
    ).first()
    assert (r.z, r.i, r.m, r.g, r.cell, r.y, r.y0, r.p) == ("1234567890", "DART_T3_007", {"T1": 1, "T2": 2}, "unknown", "a/b c", 2023, 0, "12.5%")


def test_classify(spark):
    rows = [(3, 3, "too_easy"), (0, 3, "too_hard"), (2, 3, "accepted"), (0, 0, "too_easy")]
    got = spark.createDataFrame(rows, "c int, n int, want string").select(S.classify(F.col("c"), F.col("n")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_sentences(spark):
    assert one(spark, "t string", "One.  Two!\nThree? four").select(S.sentences(F.col("t"))).first()[0] == ["One.", "Two!", "Three?", "four"]


def test_markdown_table(spark):
    text = "x\n| a | b | c |\n|---|:---:|---|\n| 1 | 2 |\n"
    df = spark.createDataFrame([(text,), ("no pipes",), (None,)], "t string")
    assert [r[0] for r in df.select(T.parse_markdown_table(F.col("t"))).collect()] == [[["a", "b", "c"], ["1", "2", ""]], [], []]


def test_blocks_and_assembly(spark):
    text = "before. next\n\n| a |\n| 1 |\nafter\n| z |"
    r = one(spark, "t string", text).select(T.blocks(F.col("t")).alias("b")).select("b", T.assemble(F.col("b")).alias("p")).first()
    assert [x.kind for x in r.b] == ["text", "table", "text", "table"]
    assert (r.p.pre_text, r.p.table, r.p.post_text) == (["before.", "next"], [["a"], ["1"]], ["after", "| z |"])


def test_gold_inds(spark):
    schema = "q array<string>, t array<array<string>>, a array<string>, b array<string>"
    rows = [(["x | y", "p", "z|w", " "], [], [], []), ([], [["h"], ["1", "2"]], [], []), ([], [], ["s"], []), (None, [], [], ["e"]), ([], [], [], [])]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(T.gold_inds(*[F.col(c) for c in "qtab"])).collect()]
    assert got == [{"table_0": "x | y", "text_0": "p", "table_1": "z|w"}, {"table_0": "1 | 2"}, {"text_0": "s"}, {"text_0": "e"}, {}]


words = st.lists(st.text("ab.!", min_size=1, max_size=5), min_size=1, max_size=60).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["text", "table"]), words), max_size=6), st.integers(3, 20), st.integers(0, 2))
def test_packing_loses_nothing(blocks, size, overlap):
    packer = Packer(size, overlap)
    found = list(packer.pack(blocks))
    bare = Packer(size, 0)
    assert "".join("".join(t for t, _ in bare.pack(blocks)).split()) == "".join("".join(t for _, t in blocks).split())
    assert all(packer.count(t) <= size + overlap for t, kinds in found if "table" not in kinds)
    assert sum("table" in k for _, k in found) <= sum(k == "table" for k, _ in blocks)


def test_packing_examples():
    sentence = "이 회사는 반도체를 만든다. "
    assert len(list(Packer(512, 50).pack([("text", sentence * 5)]))) == 1
    long = list(Packer(64, 10).pack([("text", sentence * 200)]))
    assert len(long) >= 2 and all(Packer().count(t) <= 74 for t, _ in long)
    table = "\n".join(f"| 항목{i} | 값{i} |" for i in range(20))
    found = list(Packer(64, 10).pack([("text", "앞 문장."), ("table", table), ("text", "뒤 문장.")]))
    assert all(f"값{i}" in "".join(t for t, k in found if "table" in k) for i in range(20))


def test_registered_functions(spark):
    import io
    import zipfile

    from sparkquill.functions.registered import register

    register(spark)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        archive.writestr("a.xml", "<p>II. Body</p><p>1. Part</p><p>text of it</p>")
        archive.writestr("b.txt", "x")
    spark.createDataFrame([(bytearray(held.getvalue()), "<p>one two</p><table><tr><td>x</td></tr></table>", 'so {"a": {}}')], "content binary, html string, reply string").createOrReplaceTempView("held")
    got = spark.sql("select m.name, s.strategy, s.html from held, lateral zip_members(content) m, lateral section_of(m.markup, array('Body'), array('Part')) s").collect()
    assert [tuple(r) for r in got] == [("a.xml", "textual", "<p>text of it</p>")]
    assert [(r.pos, r.kind) for r in spark.sql("select b.* from held, lateral html_blocks(html) b").collect()] == [(0, "text"), (1, "table")]
    assert [(r.text, r.token_count) for r in spark.sql("select c.* from held, lateral html_chunks(html, 100, 0) c").collect()] == [("one two\n\n| x |\n| --- |", 8)]
    assert spark.sql("select outermost_json(reply) as j from held").first().j == '{"a": {}}'


def test_a_markdown_table_is_taken_apart_once(spark):
    text = "| a | b |\n| --- | --- |\n| 1 |\n||\n| -- | : |"
    df = spark.createDataFrame([(text,)], "t string").select(T.parse_markdown_table(F.col("t")).alias("rows"))
    assert [list(r) for r in df.first().rows] == [["a", "b"], ["1", ""], ["", ""], ["--", ":"]]
    # lines are cut in one place of the plan, not again in the lambda of each row
    plan = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert plan.count("split(coalesce(") + plan.count("split(t") == 1, plan
