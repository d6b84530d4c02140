from __future__ import annotations

import hashlib
import json
import math
import random
import struct
import time
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkquill import schemas
from sparkquill.functions import scalars as S
from sparkquill.functions import tables
from sparkquill.operators import chunking, evidence, export, generation, grading, html_blocks, index, relational, review, sections
from sparkquill.plans import catalog
from sparkquill.sources import files
from sparkquill.streaming.incremental import store_new


def test_relational(spark):
    rows = spark.createDataFrame([("a", "20240101", 1), ("a", "20240301", 2), ("a", "20240301", 3), ("b", "20231231", 4)], "k string, rcept_dt string, ord int")
    assert {(r.k, r.ord) for r in relational.latest(rows, ["k"], "rcept_dt", "ord").collect()} == {("a", 2), ("b", 4)}
    assert {(r.k, r.ord) for r in relational.last_wins(rows, ["k"], "ord").collect()} == {("a", 3), ("b", 4)}
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    assert sorted((r.ord, r.year) for r in relational.fiscal_window(rows, years).collect()) == [(1, 2023), (1, 2024), (2, 2023), (2, 2024), (3, 2023), (3, 2024), (4, 2023)]
    assert relational.subset(rows, "k", []).count() == 4 and relational.subset(rows, "k", ["b"]).count() == 1
    ids = spark.createDataFrame([("DART_T1_003",), ("DART_T1_x",), ("DART_T2_009",)], "id string")
    assert relational.next_slot(ids, "id", "DART_T1_").first()[0] == 4


def test_html_tables():
    html = "<p>a</p><table><tr><th>h1</th><th colspan=2>h2</th></tr><tr><td rowspan=2>1,000</td><td>x</td><td>y</td></tr><tr><td>z</td></tr></table><script>no</script><p>b</p>"
    found = html_blocks.blocks(html)
    assert [k for k, _ in found] == ["text", "table", "text"]
    assert found[1][1] == "| h1 | h2 | h2 |\n| --- | --- | --- |\n| 1,000 | x | y |\n| 1,000 | z |  |"
    assert html_blocks.largest_table(html).startswith("| h1 |") and html_blocks.largest_table("<p>x") == ""
    assert html_blocks.blocks(None) == []


STRUCTURED = "<DOCUMENT><SECTION-1><TITLE>II. 사업의 내용</TITLE><SECTION-2><TITLE>1. 사업의 개요</TITLE><P>개요 본문</P></SECTION-2><SECTION-2><TITLE>2. 주요 제품</TITLE><P>제품</P></SECTION-2></SECTION-1></DOCUMENT>"
FLAT = "<p>I. 회사의 개요</p><p>1. 사업의 개요</p><p>다른 곳</p><p>Ⅱ. 사업의 내용</p><p>1. 사업의 개요</p><p>본문 하나</p><table><tr><td>표</td></tr></table><p>2. 주요 제품</p><p>아님</p>"
SPEC = sections.Spec("overview", ("사업의 내용",), ("사업의 개요",))


def test_sections(spark):
    assert "개요 본문" in sections.structured(html_blocks.soup(STRUCTURED), SPEC)
    found = sections.textual(html_blocks.soup(FLAT), SPEC)
    assert "본문 하나" in found and "표" in found and "다른 곳" not in found and "아님" not in found
    reports = spark.createDataFrame([("r1", "b.xml", 1, FLAT), ("r1", "a.xml", 0, STRUCTURED), ("r2", "c.xml", 0, "<p>nothing</p>")], "report string, member string, member_ord int, markup string")
    got = {(r.report, r.found, r.strategy) for r in sections.extracted(reports, [SPEC]).collect()}
    assert got == {("r1", True, "structured"), ("r2", False, None)}
    assert sections.success(sections.extracted(reports, [SPEC])).first().share == 0.5


def test_verification(spark):
    ev = {"c1": "매출은  1,000억원\n이다"}
    good = {"question": "q", "gold_answer": "1", "gold_answer_unit": "억원", "evidence_chunks": ["c1"], "evidence_quotes": ["매출은 1,000억원"], "reasoning_steps": ["a", "b"], "reasoning_hops": 2}
    cases = [
        (good, "ok"), ({k: v for k, v in good.items() if k != "gold_answer_unit"}, "missing_fields"), (good | {"gold_answer_unit": None}, "ok"), (good | {"reasoning_steps": []}, "no_steps"), (good | {"reasoning_steps": "a"}, "no_steps"),
        (good | {"reasoning_hops": "x"}, "hops_not_a_number"), (good | {"reasoning_hops": "2"}, "ok"), (good | {"reasoning_hops": 2.9}, "ok"), (good | {"reasoning_hops": 3}, "hops_differ_from_steps"), (good | {"evidence_quotes": []}, "no_quotes"),
        (good | {"evidence_chunks": ["c9"]}, "unknown_evidence"), (good | {"evidence_quotes": [" "]}, "blank_quote"), (good | {"evidence_quotes": [5]}, "blank_quote"), (good | {"evidence_quotes": ["없는 말"]}, "quote_not_in_evidence"),
        (good | {"gold_answer": ["1"]}, "gold_not_a_single_value"), (good | {"gold_answer": None}, "gold_not_a_single_value"), (good | {"gold_answer": {"a": 1}}, "gold_not_a_single_value"), (good | {"gold_answer": 12.5}, "ok"), (good | {"gold_answer": "[1]"}, "ok"), (None, "missing_fields"),
    ]
    df = spark.createDataFrame([(i, None if p is None else json.dumps(p), ev) for i, (p, _) in enumerate(cases)], "i int, p string, ev map<string,string>")
    got = {r.i: r.got for r in df.select("i", evidence.verified(F.col("p"), F.col("ev")).alias("got")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_drafts_and_rewrites(spark):
    shown = {"c1": "sales were 12 in the year"}
    reply = json.dumps({"question": "q", "gold_answer": 12, "gold_answer_unit": "", "evidence_chunks": ["c1"], "evidence_quotes": ["sales were 12"], "reasoning_steps": ["a"], "reasoning_hops": 1})
    held = [("T1", 1, 1, "no json", None, shown), ("T1", 1, 2, f"```json\n{reply}\n```", None, shown), ("T1", 1, 3, reply, None, shown), ("T1", 2, 1, reply, None, None), ("T2", 1, 1, None, "timeout", shown), ("T2", 1, 2, "{}", None, shown)]
    replies = spark.createDataFrame([(*r, "co", "2024_A", "sec") for r in held], "task_type string, slot int, attempt int, reply string, error string, shown map<string,string>, company string, report string, section string")
    got = {(r.task_type, r.slot): r for r in generation.drafted(replies).collect()}
    assert {k: r.verdict for k, r in got.items()} == {("T1", 1): "ok", ("T1", 2): "no_evidence", ("T2", 1): "missing_fields"}
    assert got["T1", 1]["item"].id == "DART_T1_001" and got["T1", 1]["item"].gold_answer == "12" and got["T1", 1]["item"].generation_notes == "" and got["T2", 1]["item"] is None
    assert {tuple(r) for r in generation.discard_reasons(generation.drafted(replies)).collect()} == {("T1", "no_evidence", 1), ("T2", "missing_fields", 1)}
    items = spark.createDataFrame([_item(id=i, evidence_chunks=c) for i, c in (("a", ["c1"]), ("b", ["c1"]), ("c", ["gone"]), ("d", ["c1"]))], schemas.ITEM)
    new = spark.createDataFrame([("a", reply), ("b", "nothing"), ("c", reply)], "id string, reply string")
    out = {r.id: r for r in review.rewritten(items, new, spark.createDataFrame([("c1", shown["c1"])], "chunk_id string, text string")).collect()}
    assert {i: r.verdict for i, r in out.items()} == {"a": "ok", "b": "no_json", "c": "no_evidence", "d": None}
    assert out["a"].gold_answer == "12" and out["a"].reasoning_hops == 1 and out["a"].source_company == _item()["source_company"]
    assert all(out[i].question == _item()["question"] for i in "bcd")


def test_prompts_and_quotes(spark):
    row = spark.createDataFrame([("a.b a.b axb", [{"chunk_id": "c", "text": "x {year}", "section": None, "has_table": True}])], "t string, c array<struct<chunk_id:string,text:string,section:string,has_table:boolean>>")
    got = row.select(
        S.quote_spans(F.col("t"), F.array(F.lit("a.b"), F.lit(""), F.lit("zz"))).alias("s"),
        evidence.prompt("of {company}, {year}: {chunks_block}{year}", company=F.lit("co"), year=F.lit(2024), chunks_block=evidence.block(F.col("c"))).alias("p"),
    ).first()
    assert [tuple(s) for s in got.s] == [(0, 3), (4, 7)]
    assert got.p == "of co, 2024: --- chunk_id=c | section=None | has_table=True ---\nx {year}\n2024"


def test_tables_and_blocks_by_line_ends(spark):
    text = "||a|b||\r\n|:--:| - -- |\r\n| x |\r\nprose one\r\n\r\nprose two\x85|y|"
    row = spark.createDataFrame([(text,)], "t string").select(tables.parse_markdown_table(F.col("t")).alias("rows"), tables.blocks(F.col("t")).alias("blocks")).first()
    assert row["rows"] == [["", "a", "b", ""], ["x", "", "", ""], ["y", "", "", ""]]
    assert [(b.kind, b.text) for b in row.blocks] == [("table", "||a|b||\n|:--:| - -- |\n| x |"), ("text", "prose one\nprose two"), ("table", "|y|")]


def test_small_roman_signs_are_headings(spark):
    row = spark.createDataFrame([("ⅱ．사업의   내용",)], "t string").select(S.normalize_heading(F.col("t")).alias("n"), S.heading_kind(S.normalize_heading(F.col("t"))).alias("k")).first()
    assert (row.n, row.k) == ("II.사업의 내용", "top") and sections.normalized("ⅱ．사업의   내용") == "II.사업의 내용"


def test_repeated_headings_go_on(spark):
    flat = "<p>II. 사업의 내용</p><p>1. 사업의 개요</p><p>하나</p><p>1. 사업의 개요 (계속)</p><p>둘</p><p>Ⅱ. 사업의 내용 (계속)</p><p>셋</p><p>1. 사업의 개요</p><p>넷</p><p>2. 주요 제품</p><p>아님</p>"
    found = sections.textual(html_blocks.soup(flat), SPEC)
    assert [x for x in ("하나", "둘", "셋", "넷", "아님") if x in found] == ["하나", "둘", "넷"]
    assert sections.textual(html_blocks.soup("<p>II. 사업의 내용</p><p>1. 사업의 개요</p><p>2. 주요 제품</p>"), SPEC) is None


def test_deep_markup():
    deep = "<div>" * 5000
    assert html_blocks.blocks(f"<table>{deep}<tr><td rowspan=9>x</td></tr></table>")[0][1].startswith("| x |")
    inner = sections.structured(html_blocks.soup(f"<section-1><title>II. 사업의 내용</title><section-2><title>1. 사업의 개요</title>{deep}x</section-2></section-1>"), SPEC)
    assert inner == f"{deep}x{'</div>' * 5000}"


def test_packing_is_linear_and_whole():
    text = "word and. more " * 27_000
    began = time.perf_counter()
    packed = list(chunking.Packer(512, 0).pack([("text", text)]))
    assert time.perf_counter() - began < 2
    assert "".join("".join(t.split()) for t, _ in packed) == "".join(text.split()) and all(len(t.split()) <= 512 for t, _ in packed)


def test_section_chunks_from_html(spark):
    html = f"<p>{'A sentence of words. ' * 60}</p><table><tr><td>a</td><td>b</td></tr></table><p>end</p>"
    pages = spark.createDataFrame([("co", 2024, "s", None, html), ("co", 2024, "t", "A1", None)], "company string, year int, section string, report_code string, html string")
    got = chunking.section_chunks(pages, "html", 64, 10).collect()
    want = list(chunking.Packer(64, 10).pack(html_blocks.blocks(html)))
    assert [(r.chunk_id, r.text, r.block_kinds) for r in got] == [(f"co_2024_s_{i:03d}", t, k) for i, (t, k) in enumerate(want)] and len(want) > 2
    rows = [("co", 2024, "s", "A1", i, k, t) for i, (k, t) in enumerate(html_blocks.blocks(html))]
    grouped = chunking.chunks(spark.createDataFrame(rows, "company string, year int, section string, report_code string, pos int, kind string, payload string"), 64, 10)
    assert sorted((r.chunk_id, r.text) for r in grouped.collect()) == sorted((r.chunk_id, r.text) for r in got)


def test_top_k_without_a_key_matches_brute_force(spark):
    rng = random.Random(5)
    chunks = [(i, [float(rng.randrange(4)) for _ in range(3)]) for i in range(3000)] + [(5000 + i, [1.0, 1.0, 1.0]) for i in range(3000)] + [(9999, None)]
    asked = [(q, [rng.random() * 3 for _ in range(3)]) for q in range(23)] + [(50, [1.0, 1.0, 1.0])]
    got = {}
    for most in (10_000, 7):
        found = index.top_k(spark.createDataFrame(asked, "question_id long, q array<float>"), spark.createDataFrame(chunks, "chunk_id long, v array<float>").repartition(5), 6, [], most)
        got[most] = sorted(tuple(r) for r in found.collect())
    f = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    want = []
    for q, v in asked:
        near = sorted((round(sum((f(a) - b) ** 2 for a, b in zip(v, c, strict=True)), 9), i) for i, c in chunks if c)[:6]
        want += [(q, i, r + 1) for r, (_, i) in enumerate(near)]
    assert {(q, i, r) for q, i, _, r in got[7]} == set(want)
    assert got[10_000] == got[7]


def test_review_files_and_sinks(spark, tmp_path):
    path = str(tmp_path / "reviewed.json")
    assert files.prior_states(spark, path).count() == 0
    states = spark.createDataFrame([(1, _item(id="b"), "discarded"), (0, _item(id="a"), "edited")], f"ord long, item struct<{schemas.ITEM.replace(' string', ':string').replace(' array', ':array').replace(' int', ':int')}>, status string")
    for _ in range(2):
        files.save_reviewed(states, path, "2024-01-01T00:00:00")
    saved = json.loads((tmp_path / "reviewed.json").read_text())
    assert [s["item"]["id"] for s in saved["states"]] == ["a", "b"] and [i["id"] for i in saved["items"]] == ["a"] and saved["saved_at"].startswith("2024")
    assert [(r["item"].id, r.status) for r in files.prior_states(spark, path).collect()] == [("a", "edited"), ("b", "discarded")]
    (tmp_path / "bad.json").write_text("{no json")
    assert files.prior_states(spark, str(tmp_path / "bad.json")).count() == 0
    files.write_manifest(spark.createDataFrame([("co", None)], "company string, reason string"), str(tmp_path / "manifest.json"))
    assert json.loads((tmp_path / "manifest.json").read_text()) == [{"company": "co", "reason": None}]
    with pytest.raises(ValueError):
        files.write_json_array(spark.range(3), str(tmp_path / "x.json"), most=2)
    found = spark.createDataFrame([("co", 2024, "s", "<p>one<b>two</b></p>"), ("co", 2024, "t", None)], "company string, year int, section string, html string")
    files.write_sections(found, str(tmp_path / "sections"))
    back = {(r.kind, r.section): r.value for r in spark.read.text(str(tmp_path / "sections"), wholetext=True).collect()}
    assert back == {("html", "s"): "<p>one<b>two</b></p>\n", ("txt", "s"): "one\ntwo\n"}


def test_log_lines_and_rates(spark):
    lines = ["2024-01-02 03:04:05 | i1 | ACCEPT | a | b", "2024-01-02 | i1 | accept | x", "2024-01-02 03:04:05 | i 1 | accept | x", " 2024-01-02 03:04:05 | i2 | edit |"]
    log = review.parsed_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted((r.id, r.action, r.note) for r in log.collect()) == [("i1", "ACCEPT", "a | b"), ("i2", "edit", "")]
    rate = lambda n: review.edit_rate(log, spark.createDataFrame([(n,)], "n_total long")).first()
    assert (rate(4).accept, rate(4).edit, rate(4).edit_rate) == (1, 1, 0.25) and (rate(0).accept, rate(0).edit, rate(0).edit_rate) == (0, 0, 0.0)


def test_cursor_and_names(spark):
    states = spark.createDataFrame([(0, "a"), (1, "7"), (2, "c")], "ord long, id string")
    assert [review.jumped(states, t, 1).first()[0] for t in ("c", "3", "7", "9", "x")] == [2, 2, 1, 1, 1]
    one = spark.range(1).select(*[review.moved(F.lit(p), F.lit(s), F.lit(n)).alias(f"m{i}") for i, (p, s, n) in enumerate([(0, -1, 3), (1, 1, 3), (2, 1, 3), (0, 1, 0)])]).first()
    assert tuple(one) == (0, 2, 2, 0)
    assert [export.output_name(*a) for a in (("d/x.jsonl",), ("d/x.json", "finqa", "matched"), ("d.e/x",))] == ["d/x_finqa.jsonl", "d/x_finqa_matched.json", "d.e/x_finqa"]


def test_sources(spark, tmp_path):
    xml = "<result><list><corp_code>00000001</corp_code><corp_name> Co </corp_name><stock_code>000005</stock_code><modify_date>20240101</modify_date></list><list><corp_code>2</corp_code></list></result>"
    for name, held in (("map.zip", {"CORPCODE.xml": xml}), ("report.zip", {"b.xml": FLAT, "a.XML": STRUCTURED, "c.txt": "x"})):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            for member, text in held.items():
                archive.writestr(member, text)
    assert [tuple(r) for r in files.corp_map(spark, str(tmp_path / "map.zip")).collect()] == [("00000001", "Co", "000005", "20240101"), ("2", "", "", "")]
    got = files.archives(spark, str(tmp_path / "report.zip")).collect()
    assert [(r.member, r.member_ord) for r in got] == [("b.xml", 0), ("a.XML", 1)] and got[0].markup == FLAT
    rows = [("co", 2024, "A1", "downloaded"), ("co", 2023, None, "cached"), ("co", 2022, "A1", "failed")]
    assert sorted(r.label for r in files.manifest_pool(spark.createDataFrame(rows, "company string, year int, report_code string, status string")).collect()) == ["2023_?", "2024_A1"]
    chunk = lambda i, t: json.dumps({"chunk_id": i, "text": t, "company": "co", "year": 2024})
    (tmp_path / "chunks").mkdir()
    (tmp_path / "chunks" / "a.jsonl").write_text("\n".join([chunk("x", "old"), chunk("y", "only"), chunk("x", "mid")]))
    (tmp_path / "chunks" / "b.jsonl").write_text(chunk("x", "new"))
    assert {r.chunk_id: r.text for r in files.chunk_lookup(spark, str(tmp_path / "chunks")).collect()} == {"x": "new", "y": "only"}
    files.write_chunks(spark.createDataFrame([("x", "t", "co", 2024), ("y", "u", "co", 2023)], "chunk_id string, text string, company string, year int"), str(tmp_path / "out"))
    assert {(r.chunk_id, r.year) for r in spark.read.json(str(tmp_path / "out")).collect()} == {("x", 2024), ("y", 2023)}
    files.append_log(spark.createDataFrame([("2024-01-02 03:04:05", "i", "edit", None)], "ts string, id string, action string, note string"), str(tmp_path / "log"))
    assert [r.id for r in review.parsed_log(spark.read.text(str(tmp_path / "log"))).collect()] == ["i"]
    (tmp_path / "cal.json").write_text(json.dumps([{"item_id": "i", "classification": c} for c in ("accepted", "too_hard")]))
    rows = files.calibration(spark, str(tmp_path / "cal.json")).collect()
    assert [(r.item_id, r.classification) for r in rows] == [("i", "too_hard")]
    companies, specs = files.config_tables(spark, {"companies": [{"name": "Co", "corp_code": 126380, "stock": 5930}], "sections": [{"id": "s", "parent_patterns": ["p"], "title_patterns": ["t"]}]})
    assert tuple(companies.first())[:3] == ("Co", "00126380", "005930") and specs.first().titles == ["t"]
    with pytest.raises(KeyError):
        files.setting({}, "KEY")
    assert relational.missing(spark.range(3), spark.range(1), ["id"]).count() == 2


def test_json_extraction(spark):
    texts = ['```json\n{"a": {"b": 1}} x```', "none", None, "{bad}", 'x {"k": 2}']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(evidence.extract_json(F.col("t"))).collect()]
    assert got == ['{"a": {"b": 1}}', None, None, None, '{"k": 2}']


def test_lookup_keeps_items_and_order(spark):
    items = spark.createDataFrame([("i1", ["b", "x", "a"]), ("i2", ["x"]), ("i3", [])], "id string, evidence_chunks array<string>")
    chunks = spark.createDataFrame([("a", "A"), ("b", "B")], "chunk_id string, text string")
    back = spark.createDataFrame([("x", "X"), ("a", "other")], "chunk_id string, text string")
    assert {r.id: r.texts for r in evidence.looked_up(items, chunks).collect()} == {"i1": ["B", "A"], "i2": [], "i3": []}
    assert {r.id: r.texts for r in evidence.looked_up(items, chunks, back).collect()} == {"i1": ["B", "X", "A"], "i2": ["X"], "i3": []}


def test_quotes_found_matches_brute_force(spark):
    quotes = [(1, "b c d e f"), (2, "C  D"), (3, "x y z w v"), (4, " "), (5, "bb c d e ff")]
    docs = [(1, "a b c d e f g"), (2, "abb c d\ne ff"), (3, None), (4, "c d"), (5, "X Y Z W VV")]
    norm = lambda t: " ".join((t or "").lower().split())
    want = {(i, d) for i, q in quotes for d, t in docs if norm(q) and norm(q) in norm(t)}
    got = evidence.quotes_found(spark.createDataFrame(quotes, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string"))
    assert {tuple(r) for r in got.collect()} == want


def test_index(spark):
    chunks = spark.createDataFrame([(i, [float(i), 0.0], i % 2) for i in range(6)], "chunk_id long, v array<float>, label int")
    questions = spark.createDataFrame([(0, [0.2, 0.0], 1), (1, [5.0, 0.0], 7)], "question_id long, q array<float>, label int")
    got = {(r.question_id, r.rank): r.chunk_id for r in index.top_k_or_any(questions, chunks, 2, ["label"]).collect()}
    assert got == {(0, 1): 1, (0, 2): 3, (1, 1): 5, (1, 2): 4}
    gold = spark.createDataFrame([(0, [1]), (1, [0]), (2, [])], "question_id long, gold array<bigint>")
    hits = spark.createDataFrame([(q, c) for (q, _), c in got.items()], "question_id long, chunk_id long")
    assert index.recall(gold, hits).first().n_hit == 1
    vectors = index.embedded(spark.createDataFrame([("a b",), (None,)], "t string"), "t", size=8).collect()
    assert abs(sum(x * x for x in vectors[0].embedding) - 1) < 1e-6 and not any(vectors[1].embedding)
    batches = index.length_batches(spark.createDataFrame([(i, "w " * n) for i, n in enumerate([1, 50, 3, 200, 2])], "k int, t string").coalesce(1), "t", "k", 2, 100).collect()
    assert [(r.n_tokens, r.batch) for r in sorted(batches, key=lambda r: r.n_tokens)] == [(1, 0), (2, 0), (3, 1), (50, 1), (200, 2)]


def test_embed_hash_reads_whole_texts(spark, tmp_path):
    def brute(text):
        out = [0.0] * 64
        for w in f"passage: {text or ''}".lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
            out[h % 64] += 1 if h >= 1 << 63 else -1
        return [x / math.sqrt(sum(y * y for y in out)) for x in out]

    same = " ".join(f"w{i}" for i in range(300))
    held = [(1, f"{same} apple"), (2, f"{same} pear plum"), (3, " ".join(f"v{i % 977}" for i in range(20_000))), (4, "short"), (5, ""), (6, None)]
    spark.createDataFrame(held, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.embedding for r in catalog.QUERIES["q_embed_hash"](spark, str(tmp_path)).collect()}
    assert len(got) == len(held) and got[1] != got[2]
    for i, text in held:
        assert all(abs(a - b) < 2e-6 for a, b in zip(got[i], brute(text), strict=True)), i


def test_evidence_rank_takes_all_questions(spark, tmp_path):
    # far from each other by label, so a label's rows can come from its own questions only
    held = [(i, [float(100 * (i // 100)), float(i % 100)], i // 100) for i in range(300)]
    spark.createDataFrame(held, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = catalog.QUERIES["q_evidence_rank_by_label"](spark, str(tmp_path)).collect()
    assert {(r.label, r.rank) for r in got} == {(g, k) for g in range(3) for k in range(1, 6)}
    assert {r.seed for r in got} == {0, 50, 100, 150, 200, 250}


def test_review(spark):
    items = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "ord int, id string")
    actions = spark.createDataFrame([(0, "t0", "a", "accept", None), (1, "t1", "a", "discard", "dup"), (2, "t2", "b", "EDIT", "x")], "ord int, ts string, id string, action string, note string")
    found = review.states(items, actions)
    assert {(r.id, r.status, r.discard_reason) for r in found.collect()} == {("a", "discarded", "dup"), ("b", "edited", None), ("c", "pending", None)}
    assert review.next_pending(found, 2).first()[0] == 2
    lines = spark.createDataFrame([("2024-01-01 10:00:00 | a | accept | ",), ("2024-01-01 10:00:00 | b | edit | why | not",), ("2024-01-01 10:00:00 | c | discard | x",), ("2024-01-01 10:00:00 | d | regenerate | ",), ("bad",)], "value string")
    total = spark.createDataFrame([(4,)], "n_total int")
    rate = review.edit_rate(review.parsed_log(lines), total).first()
    assert (rate.accept, rate.edit, rate.regenerate, rate.discard, rate.edit_rate) == (1, 1, 1, 1, 0.25)


def _item(**more):
    return {"id": "i1", "question": "q?", "gold_answer": "1,234억원", "evidence_chunks": ["c1"], "evidence_quotes": [], "reasoning_steps": ["s1", "s2"], "reasoning_hops": 2, "task_type": "T1", "source_company": "co", "source_report": "2023_A", **more}


def test_export(spark):
    items = spark.createDataFrame([_item(), _item(id="i2", reasoning_hops=None, gold_answer="글"), _item(id="i3", reasoning_hops=4)], schemas.ITEM)
    calibration = spark.createDataFrame([("i1", "T1", "accepted", [("r", "1", True, 1, 1), ("r", "2", False, 1, 1)], []), ("i2", "T1", "too_easy", [], [])], schemas.CALIBRATION)
    got = export.accepted(items, calibration).collect()
    assert [(r.id, r.calibration.n_correct, r.calibration.n_attempts) for r in got] == [("i1", 1, 2)]
    assert [(r.id, r.difficulty_group) for r in export.matched(items).collect()] == [("i1", "1-2_step")]
    chunks = spark.createDataFrame([("c1", "머리.\n| a | b |\n|---|---|\n| 1 | 2 |\n꼬리.")], "chunk_id string, text string")
    out = {r.id: r for r in export.converted(items, chunks).collect()}
    assert (out["i1"].pre_text, out["i1"].table, out["i1"].post_text, out["i1"].qa.exe_ans_num, out["i1"].qa.gold_inds) == (["머리."], [["a", "b"], ["1", "2"]], ["꼬리."], 1234.0, {"table_0": "1 | 2"})
    assert out["i2"].qa.exe_ans_text == "글" and out["i1"].filename == "2023_A"
    assert tuple(export.validated(export.converted(items, chunks)).first()) == (3, 3, 0, 0)
    assert "- mean evidence chunks: 1.00" in export.report(items, calibration)


def test_calibration(spark):
    items = spark.createDataFrame([(0, "i1", "T1", "q", "10"), (1, "i2", "T2", "fail", "5")], "ord long, id string, task_type string, question string, gold_answer string")
    shown = spark.createDataFrame([("i1", "e")], "id string, evidence string")

    def provider(question, evidence):
        if question == "fail":
            raise RuntimeError
        return "최종답: 10", 5, 2

    got = grading.calibrated(items, shown, provider, 2).collect()
    assert [(r.id, r.classification, len(r.attempts)) for r in got] == [("i1", "too_easy", 2), ("i2", "too_hard", 2)]


def test_quota():
    drawn = generation.filled([("a", 1), ("b", 1)], {"T1": 3, "T2": 3}, lambda k, s, src: None if src[0] == "b" and k == "T2" else (k, s, src[0]), cap=2)
    assert drawn == [("T1", 1, "a"), ("T1", 2, "b"), ("T1", 3, "a")]


def rounds_brute(rows, quotas, cap):
    left, need, rest, out = Counter({s: cap for _, _, s in rows}), Counter(quotas), sorted(rows), []
    while True:
        seen, got, taken = Counter(), Counter(), []
        for i, k, s in rest:
            if need[k] > 0 and seen[s] < left[s]:
                seen[s] += 1
                if got[k] < need[k]:
                    got[k] += 1
                    taken.append((i, k, s))
        if not taken:
            return out
        out += taken
        left.subtract(s for _, _, s in taken)
        need.subtract(k for _, k, _ in taken)
        rest = [r for r in rest if r not in taken]


def test_quota_by_rounds(spark):
    rng = random.Random(3)
    skewed = [(i, "a", "s%d" % (i % 3)) for i in range(30)] + [(100 + i, "b", "s%d" % (i % 3)) for i in range(30)]
    mixed = [(i, rng.choice("aaaabbc"), rng.choice(["s1", "s2", "s2", "s3", None])) for i in range(80)]
    for rows, quotas, cap in [(skewed, {"a": 4, "b": 8}, 5), (mixed, {"a": 3, "b": 5, "c": 6, "d": 2}, 4), ([], {"a": 1}, 5)]:
        found = generation.filled_by_rounds(spark.createDataFrame(rows, "id int, k string, s string"), "k", "s", "id", spark.createDataFrame(list(quotas.items()), "k string, quota int"), cap)
        got = found.collect()
        want = rounds_brute(rows, quotas, cap)
        assert sorted((r.id, r.k, r.s) for r in got) == sorted(want)
        by_kind, by_source = Counter(r.k for r in got), Counter(r.s for r in got)
        assert all(n <= quotas[k] for k, n in by_kind.items()) and all(n <= cap for n in by_source.values())
        assert all(by_kind[k] == quotas.get(k, 0) or by_source[s] == cap for i, k, s in rows if (i, k, s) not in want)
        assert all([r.slot for r in sorted(got, key=lambda r: r.id) if r.k == k] == list(range(1, n + 1)) for k, n in by_kind.items())
        if rows is skewed:
            assert by_kind == quotas


def test_files(spark, tmp_path):
    item = json.dumps(_item(), ensure_ascii=False)
    for name, text in {"a": f"[{item}]", "b": f'{{"items": [{item}]}}', "c": f'{{"states": [{{"item": {item}, "status": "edited"}}, {{"item": {item}, "status": "discarded"}}]}}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
        assert [r.id for r in files.reviewed(spark, str(tmp_path / f"{name}.json")).collect()] == ["i1"], name
    (tmp_path / "s").mkdir()
    for name in ("co_2023_sec_one", "bad", "co_x_sec"):
        (tmp_path / "s" / f"{name}.html").write_text("<p>x")
    assert [(r.company, r.year, r.section) for r in files.section_files(spark, str(tmp_path / "s")).collect()] == [("co", 2023, "sec_one")]
    files.write_items(spark.createDataFrame([_item()], schemas.ITEM), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/parquet")).count() == files.json_lines(spark, str(tmp_path / "out/jsonl"), schemas.ITEM).count() == 1


def test_incremental_store(spark, tmp_path):
    source = str(tmp_path / "in")
    for k in range(2):
        spark.createDataFrame([(f"i{j}", k) for j in range(k + 2)], "item_id string, n int").write.mode("append").parquet(source)
        stream = spark.readStream.schema("item_id string, n int").parquet(source)
        store_new(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.item_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["i0", "i1", "i2"]


def test_scratch_tables_go_with_their_scope(spark):
    from pathlib import Path

    from sparkquill.shared import dropped, scratch, stored

    there = lambda df: Path(df._stored_at.removeprefix("file://")).exists()  # noqa: E731, SLF001
    with scratch(spark):
        first = stored(spark.range(3), "t")
        with scratch(spark):
            inner = stored(first, "t")
            assert inner.count() == 3
        assert there(first) and not there(inner)
    outside = stored(spark.range(3), "t")
    assert not there(first) and there(outside)
    dropped(outside)
    assert not there(outside)
