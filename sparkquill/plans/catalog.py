"""Queries by name with the SQL that gives the same rows; the tables stand in for the records of the domain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.functions import tables as MD
from sparkquill.operators import chunking, evidence, export, generation, grading, index, markup, relational, review, sections
from sparkquill.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: White space of Unicode for an engine whose \s is ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
COLLAPSED = f"trim(regexp_replace(text, '{WS}+', ' ', 'g'))"
NUM = r"-?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("q_parse_number", f"select event_id, try_cast(replace(regexp_extract(props, '{NUM}', 0), ',', '') as double) as number from events")
def parse_number(spark, d):
    return read(spark, d, "events").select("event_id", S.parse_number(F.col("props")).alias("number"))


@query("q_normalize_text", f"select doc_id, md5(lower(regexp_replace(text, '{WS}', '', 'g'))) as digest from documents")
def normalize_text(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(S.normalize_text(F.col("text"))).alias("digest"))


@query(
    "q_grade",
    f"""with p as (select event_id, try_cast(regexp_extract(props, '{NUM}', 0) as double) as p, value as g from events)
    select event_id, case when p is null then false when g = 0 then abs(p) < 0.5::double else abs(p - g) / abs(g) <= 0.5::double end as correct from p""",
)
def grade(spark, d):
    rows = read(spark, d, "events").filter("value is not null")
    # a gold value in exponent notation would be read differently as text, so it is written out
    gold = F.format_string("%.17f", "value")
    graded = S.grade(F.regexp_extract("props", NUM, 0), gold, 0.5)
    return rows.select("event_id", graded.alias("correct"))


@query("q_last_line", "select conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[-1] as answer from conversations")
def last_line(spark, d):
    return read(spark, d, "conversations").select("conv_id", "turn", S.final_answer(F.col("text")).alias("answer"))


@query("q_token_count", f"select doc_id, len(list_filter(string_split({COLLAPSED}, ' '), lambda x: x <> ''))::bigint as n_tokens from documents")
def token_count(spark, d):
    return read(spark, d, "documents").select("doc_id", F.size(S.tokens(F.col("text"))).cast("long").alias("n_tokens"))


@query(
    "q_sentences",
    f"""with s as (select doc_id, list_filter(string_split(regexp_replace({COLLAPSED}, '([.!?。]) +', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') as s from documents)
    select doc_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as pos from s""",
)
def sentences(spark, d):
    return read(spark, d, "documents").select("doc_id", F.posexplode(S.sentences(F.col("text"))).alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("long"))


@query("q_year_of_report", "select o_orderkey, year(o_orderdate)::int as year from orders")
def year_of_report(spark, d):
    report = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("_A001"))
    return read(spark, d, "orders").select("o_orderkey", S.report_year(report).alias("year"))


@query("q_code_padding", "select c_custkey, case when length(c_custkey::varchar) < 8 then lpad(c_custkey::varchar, 8, '0') else c_custkey::varchar end as code from customer")
def code_padding(spark, d):
    return read(spark, d, "customer").select("c_custkey", S.zfill(F.col("c_custkey").cast("string"), 8).alias("code"))


@query(
    "q_difficulty_class",
    """select l_orderkey, count(*) filter (l_returnflag = 'N') as n_correct, count(*) as n_attempts,
    case when count(*) filter (l_returnflag = 'N') = count(*) then 'too_easy' when count(*) filter (l_returnflag = 'N') = 0 then 'too_hard' else 'accepted' end as classification
    from lineitem group by l_orderkey""",
)
def difficulty_class(spark, d):
    return grading.classified(read(spark, d, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "N")


@query("q_class_histogram", f"select classification, count(*) as n from ({ORACLES['q_difficulty_class']}) group by classification")
def class_histogram(spark, d):
    return grading.histogram(difficulty_class(spark, d), "classification")


@query(
    "q_token_usage",
    """select sum(n_chars)::bigint as input_tokens, sum(length(lang))::bigint as output_tokens,
    round(sum(n_chars) / 1e6 * 3e-1 + sum(length(lang)) / 1e6 * 25e-1, 6) as usd from documents""",
)
def token_usage(spark, d):
    rows = read(spark, d, "documents").select(F.col("n_chars").alias("input_tokens"), F.length("lang").alias("output_tokens"))
    return grading.usage(rows, 0.3, 2.5)


@query("q_cost_estimate", "select count(*) as n_chunks, sum(n_chars)::bigint as total_tokens, round(sum(n_chars) / 1e6 * 2e-2, 6) as estimated_usd from documents")
def cost_estimate(spark, d):
    return grading.embedding_cost(read(spark, d, "documents"), 0.02, "n_chars")


@query("q_run_budget", "select lang, count(*) as n_items, round(count(*) * 3 * 1500 / 1e6 * 3e-1 + count(*) * 3 * 200 / 1e6 * 25e-1, 6) as usd from documents group by lang")
def run_budget(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n_items")).withColumn("usd", grading.budget(F.col("n_items"), 3, 0.3, 2.5))


@query(
    "q_latest_filing",
    """select o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d') as rcept_dt from orders
    qualify row_number() over (partition by o_custkey order by strftime(o_orderdate, '%Y%m%d') desc, o_orderkey) = 1""",
)
def latest_filing(spark, d):
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"))
    return relational.latest(rows, ["o_custkey"], "rcept_dt", "o_orderkey")


@query(
    "q_preferred_report",
    """with p as (select o_custkey, o_orderkey, o_orderpriority, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority)::bigint as preference_rank from orders)
    select * from p where preference_rank > 0 qualify row_number() over (partition by o_custkey order by preference_rank, o_orderkey) = 1""",
)
def preferred_report(spark, d):
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return relational.preferred(rows, ["o_custkey"], "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], F.col("o_orderkey"))


@query(
    "q_fiscal_window",
    """select y.year, count(*) as n, min(strftime(o_orderdate, '%Y%m%d')) as first_dt, max(strftime(o_orderdate, '%Y%m%d')) as last_dt
    from orders, (select distinct year(o_orderdate)::int as year from orders) y
    where strftime(o_orderdate, '%Y%m%d') between y.year::varchar || '0101' and (y.year + 1)::varchar || '0630' group by y.year""",
)
def fiscal_window(spark, d):
    rows = read(spark, d, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"), F.year("o_orderdate").alias("own"))
    years = rows.select(F.col("own").alias("year")).distinct()
    found = relational.fiscal_window(rows, years)
    return found.groupBy("year").agg(F.count("*").alias("n"), F.min("rcept_dt").alias("first_dt"), F.max("rcept_dt").alias("last_dt"))


@query("q_keyword_filter", "select p_partkey, p_type from part where contains(p_type, 'BRASS') or contains(p_type, 'ECONOMY') or contains(p_type, 'STEEL')")
def keyword_filter(spark, d):
    return relational.with_keyword(read(spark, d, "part").select("p_partkey", "p_type"), "p_type", ["BRASS", "ECONOMY", "STEEL"])


@query(
    "q_code_resolve",
    """with m as (select n_nationkey, n_regionkey from nation where n_regionkey < 3)
    select c.c_name as name, c.c_nationkey::varchar as stock, lpad(coalesce(m.n_regionkey::varchar || '7', c.c_custkey::varchar), 8, '0') as corp_code,
    coalesce(lpad(c.c_custkey::varchar, 8, '0') <> lpad(coalesce(m.n_regionkey::varchar || '7', c.c_custkey::varchar), 8, '0'), false) as mismatch
    from customer c left join m on c.c_nationkey = m.n_nationkey""",
)
def code_resolve(spark, d):
    companies = read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("stock"), F.col("c_custkey").cast("string").alias("corp_code"))
    corp_map = read(spark, d, "nation").filter("n_regionkey < 3").select(
        F.col("n_nationkey").cast("string").alias("stock"), F.concat(F.col("n_regionkey").cast("string"), F.lit("7")).alias("resolved_code"), F.col("n_nationkey").alias("ord")
    )
    return relational.resolve_codes(companies, corp_map)


@query("q_status_summary", "select o_orderstatus as status, count(*) as n, round(count(*) * 1e0 / greatest((select count(*) from orders), 1), 6) as share from orders group by 1")
def status_summary(spark, d):
    rows = read(spark, d, "orders")
    total = rows.agg(F.greatest(F.count("*"), F.lit(1)).alias("total"))
    counts = grading.histogram(rows.withColumnRenamed("o_orderstatus", "status"), "status")
    return counts.crossJoin(total).select("status", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query(
    "q_stats_grouping",
    """select case when grouping(o_orderpriority) = 0 then 'o_orderpriority' when grouping(o_orderstatus) = 0 and grouping(o_year) = 0 then 'o_orderstatus+o_year' else 'o_orderstatus' end as grouping,
    o_orderpriority, o_orderstatus, o_year, count(*) as n from (select *, year(o_orderdate)::int as o_year from orders)
    group by grouping sets ((o_orderpriority), (o_orderstatus), (o_orderstatus, o_year))""",
)
def stats_grouping(spark, d):
    rows = read(spark, d, "orders").select("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("o_year"))
    return export.statistics(rows, [["o_orderpriority"], ["o_orderstatus"], ["o_orderstatus", "o_year"]])


@query("q_select_accepted", "select d.doc_id, d.source, l.toxic::int as n_correct from documents d join labels l using (doc_id) where l.quality = 1")
def select_accepted(spark, d):
    items = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "source")
    attempts = F.array(F.struct((F.col("toxic") == 1).alias("correct")))
    calibration = read(spark, d, "labels").select(
        F.col("doc_id").alias("item_id"), F.when(F.col("quality") == 1, "accepted").otherwise("too_hard").alias("classification"), attempts.alias("attempts"), F.array().cast("array<string>").alias("retrieved_chunk_ids")
    )
    return export.accepted(items, calibration).select(F.col("id").alias("doc_id"), "source", "calibration.n_correct")


@query(
    "q_finqa_matched",
    """with t as (select conv_id, count(*) as hops from conversations group by conv_id)
    select conv_id, hops, case when hops <= 2 then '1-2_step' when hops = 3 then '3_step' else '4plus_step' end as difficulty_group, true as finqa_matched from t where hops <= 5""",
)
def finqa_matched(spark, d):
    turns = read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("hops"))
    return export.matched(turns, 5, "hops")


@query(
    "q_difficulty_group",
    """with t as (select conv_id, nullif(count(*), 1) as hops from conversations group by conv_id)
    select case when hops is null then 'unknown' when hops <= 2 then '1-2_step' when hops = 3 then '3_step' else '4plus_step' end as difficulty_group, count(*) as n from t group by 1""",
)
def difficulty_group(spark, d):
    turns = read(spark, d, "conversations").groupBy("conv_id").agg(F.nullif(F.count("*"), F.lit(1)).alias("hops"))
    return grading.histogram(turns.select(S.difficulty_group(F.col("hops")).alias("difficulty_group")), "difficulty_group")


@query(
    "q_review_progress",
    """select o.o_orderpriority as task_type, count(*) filter (case s.o_orderstatus when 'O' then 'pending' else coalesce(s.o_orderstatus, 'pending') end <> 'pending') as done, count(*) as total
    from orders o left join (select * from orders where o_orderkey % 3 = 0) s using (o_orderkey) group by 1""",
)
def review_progress(spark, d):
    orders = read(spark, d, "orders")
    drafts = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("task_type"))
    prior = orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise(F.col("o_orderstatus")).alias("status"))
    return review.progress(review.resumed(drafts, prior))


@query(
    "q_review_states",
    """with a as (select user_id as id, event_id, case event_type when 'click' then 'accept' when 'view' then 'discard' when 'purchase' then 'edit' else 'regenerate' end as action from events
      qualify row_number() over (partition by user_id order by event_id desc) = 1)
    select c_custkey as id, coalesce(case action when 'accept' then 'accepted' when 'discard' then 'discarded' when 'edit' then 'edited' when 'regenerate' then 'pending' end, 'pending') as status,
    case when action = 'discard' then 'n' || event_id::varchar end as discard_reason from customer left join a on a.id = c_custkey""",
)
def review_states(spark, d):
    action = F.when(F.col("event_type") == "click", "accept").when(F.col("event_type") == "view", "discard").when(F.col("event_type") == "purchase", "edit").otherwise("regenerate")
    actions = read(spark, d, "events").select(
        F.col("event_id").alias("ord"), F.col("ts").cast("string").alias("ts"), F.col("user_id").alias("id"), action.alias("action"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note")
    )
    items = read(spark, d, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_custkey").alias("id"))
    return review.states(items, actions).select("id", "status", "discard_reason")


@query(
    "q_second_pass_diff",
    """with a as (select doc_id as id, lang as status, source, n_chars from documents where doc_id % 3 <> 0),
    b as (select doc_id as id, case when doc_id % 5 = 0 then 'xx' else lang end as status, case when doc_id % 7 = 0 then null else source end as source, n_chars + (doc_id % 2) as n_chars from documents where doc_id % 4 <> 0)
    select coalesce(a.id, b.id) as id, a.status is distinct from b.status as status_changed,
    concat_ws(',', case when a.n_chars is distinct from b.n_chars then 'n_chars' end, case when a.source is distinct from b.source then 'source' end) as changed
    from a full join b on a.id = b.id""",
)
def second_pass_diff(spark, d):
    return _passes(spark, d).select("id", "status_changed", F.array_join("changed", ",").alias("changed"))


def _passes(spark, d):
    docs = read(spark, d, "documents")
    first = docs.filter("doc_id % 3 != 0").select(F.col("doc_id").alias("id"), F.col("lang").alias("status"), "source", "n_chars")
    second = docs.filter("doc_id % 4 != 0").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 5 == 0, "xx").otherwise(F.col("lang")).alias("status"),
        F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("source"),
        (F.col("n_chars") + F.col("doc_id") % 2).alias("n_chars"),
    )
    return review.second_pass(first, second, ["source", "n_chars"])


@query(
    "q_edit_rate",
    """with l as (select case o_orderstatus when 'F' then 'accept' when 'O' then 'EDIT' else 'discard' end as action from orders where o_orderkey % 9 <> 0)
    select count(*) filter (lower(action) = 'accept') as accept, count(*) filter (lower(action) = 'edit') as edit, count(*) filter (lower(action) = 'regenerate') as regenerate,
    count(*) filter (lower(action) = 'discard') as discard, (select count(*) from customer) as n_total,
    round(count(*) filter (lower(action) = 'edit') * 1e0 / (select count(*) from customer), 6) as edit_rate from l""",
)
def edit_rate(spark, d):
    action = F.when(F.col("o_orderstatus") == "F", "accept").when(F.col("o_orderstatus") == "O", "EDIT").otherwise("discard")
    line = review.log_line(F.col("o_orderdate").cast("string"), F.col("o_orderkey").cast("string"), action, F.lit("a | note"))
    lines = read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 9 == 0, "no log line").otherwise(line).alias("value"))
    return review.edit_rate(review.parsed_log(lines), read(spark, d, "customer").agg(F.count("*").alias("n_total")))


def _questions(spark, d):
    return read(spark, d, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("q"), "label")


def _chunks(spark, d):
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("v"), "label")


DISTANCE = "round(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda x: (x[1]::double - x[2]::double) * (x[1]::double - x[2]::double))), 9)"


def _topk_sql(on: str, k: int) -> str:
    return f"""select q.vec_id as question_id, v.vec_id as chunk_id, {DISTANCE} as distance, row_number() over (partition by q.vec_id order by {DISTANCE}, v.vec_id)::int as rank
    from embeddings q join embeddings v on {on} where q.vec_id % 50 = 0 qualify row_number() over (partition by q.vec_id order by {DISTANCE}, v.vec_id) <= {k}"""


@query("q_topk_filtered", _topk_sql("q.label = v.label", 8))
def topk_filtered(spark, d):
    return index.top_k(_questions(spark, d), _chunks(spark, d), 8, ["label"])


@query("q_topk_fallback", f"{_topk_sql('q.label = v.label and v.label < 5', 8)} union all {_topk_sql('q.label >= 5 and v.label < 5', 8)}")
def topk_fallback(spark, d):
    return index.top_k_or_any(_questions(spark, d), _chunks(spark, d).filter("label < 5"), 8, ["label"])


GOLD = f"""with gold as (select question_id, list(chunk_id) as gold from ({_topk_sql('q.label = v.label', 3)}) group by question_id),
    hits as (select question_id, list(chunk_id) as found from ({_topk_sql('true', 15)}) group by question_id),
    j as (select g.question_id, e.label, list_has_all(h.found, g.gold) as hit from gold g join hits h using (question_id) join embeddings e on e.vec_id = g.question_id)"""


def _recall(spark, d, group):
    questions, chunks = _questions(spark, d), _chunks(spark, d)
    gold = index.top_k(questions, chunks, 3, ["label"]).groupBy("question_id").agg(F.collect_list("chunk_id").alias("gold"))
    gold = gold.join(questions.select("question_id", "label"), "question_id")
    return index.recall(gold, index.top_k(questions.drop("label"), chunks.drop("label"), 15, []), group)


@query("q_recall_at_k", f"{GOLD} select count(*) as n, count(*) filter (hit) as n_hit, round(avg(hit::int::double), 6) as recall from j")
def recall_at_k(spark, d):
    return _recall(spark, d, None)


@query("q_recall_by_type", f"{GOLD} select label, count(*) as n, count(*) filter (hit) as n_hit, round(avg(hit::int::double), 6) as recall from j group by label")
def recall_by_type(spark, d):
    return _recall(spark, d, "label")


@query(
    "q_evidence_rank",
    f"""with hits as (select 1 as g, question_id as seed, rank, chunk_id, distance from ({_topk_sql('true', 8)}) where question_id in (0, 50)),
    u as (select * from hits qualify row_number() over (partition by g, chunk_id order by seed, rank) = 1)
    select g, chunk_id, seed, row_number() over (partition by g order by chunk_id % 2 = 0 desc, distance, seed * 100 + rank)::int as rank from u
    qualify row_number() over (partition by g order by chunk_id % 2 = 0 desc, distance, seed * 100 + rank) <= 5""",
)
def evidence_rank(spark, d):
    two = _questions(spark, d).filter("question_id in (0, 50)").drop("label")
    hits = index.top_k(two, _chunks(spark, d).drop("label"), 8, []).withColumn("g", F.lit(1)).withColumnRenamed("question_id", "seed")
    union = evidence.first_seen(hits, "g").withColumns({"has_table": F.col("chunk_id") % 2 == 0, "ord": F.col("seed") * 100 + F.col("rank")})
    return evidence.ranked(union.drop("rank"), "g", 2, 5).select("g", "chunk_id", "seed", "rank")


@query(
    "q_evidence_rank_by_label",
    f"""with hits as (select q.label, h.question_id as seed, h.rank, h.chunk_id, h.distance from ({_topk_sql('true', 8)}) h join embeddings q on q.vec_id = h.question_id),
    u as (select * from hits qualify row_number() over (partition by label, chunk_id order by seed, rank) = 1),
    r as (select *, count(*) over (partition by label) as n, row_number() over (partition by label order by chunk_id % 2 = 0 desc, distance, seed * 100 + rank)::int as place from u)
    select label, chunk_id, seed, place as rank from r where n >= 2 and place <= 5""",
)
def evidence_rank_by_label(spark, d):
    """As q_evidence_rank, of all questions instead of two: those of a label are the seeds of a group."""
    questions = _questions(spark, d)
    hits = index.top_k(questions.drop("label"), _chunks(spark, d).drop("label"), 8, []).join(questions.select("question_id", "label"), "question_id").withColumnRenamed("question_id", "seed")
    union = evidence.first_seen(hits, "label").withColumns({"has_table": F.col("chunk_id") % 2 == 0, "ord": F.col("seed") * 100 + F.col("rank")})
    return evidence.ranked(union.drop("rank"), "label", 2, 5).select("label", "chunk_id", "seed", "rank")


@query("q_footnote_filter", r"select doc_id, regexp_matches(text, '\(주\s*[0-9]\)|주[0-9]\)|\*[^*]') as has_footnote from documents")
def footnote_filter(spark, d):
    return read(spark, d, "documents").select("doc_id", S.has_footnote(F.col("text")).alias("has_footnote"))


@query(
    "q_evidence_text",
    "select conv_id, md5(string_agg(text, chr(10) || chr(10) order by turn)) as digest, count(*) as n from conversations group by conv_id",
)
def evidence_text(spark, d):
    turns = read(spark, d, "conversations")
    found = evidence.joined(turns, ["conv_id"], "turn", "text")
    return found.join(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conv_id").select("conv_id", F.md5("evidence").alias("digest"), "n")


@query(
    "q_evidence_lookup",
    """with p as (select l_orderkey as id, l_linenumber as pos, l_partkey as chunk_id from lineitem)
    select p.id, coalesce(string_agg(t.p_name, '|' order by p.pos, p.chunk_id), '') as texts from p left join (select * from part where p_partkey % 4 <> 0) t on t.p_partkey = p.chunk_id group by p.id""",
)
def evidence_lookup(spark, d):
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("evidence_chunks"))
    parts = read(spark, d, "part").filter("p_partkey % 4 != 0").select(F.col("p_partkey").alias("chunk_id"), F.col("p_name").alias("text"))
    return evidence.looked_up(lines, parts).select("id", F.array_join("texts", "|").alias("texts"))


@query(
    "q_quote_in_evidence",
    f"""with b as (select item_id, trim(regexp_replace(lower(text), '{WS}+', ' ', 'g')) as quote from benchmark), d as (select doc_id, trim(regexp_replace(lower(text), '{WS}+', ' ', 'g')) as body from documents)
    select item_id, doc_id from b, d where quote <> '' and contains(body, quote)""",
)
def quote_in_evidence(spark, d):
    return evidence.quotes_found(read(spark, d, "benchmark"), read(spark, d, "documents"))


@query(
    "q_gold_inds",
    """with q as (select conv_id, turn, text, case when contains(text, '?') then 'table' else 'text' end as kind from conversations)
    select conv_id, kind || '_' || (row_number() over (partition by conv_id, kind order by turn) - 1)::varchar as key, md5(text) as digest from q""",
)
def gold_inds(spark, d):
    # a question mark stands in for the pipe of a table row
    quote = F.when(F.contains("text", F.lit("?")), F.concat(F.lit("|"), "text")).otherwise(F.replace("text", F.lit("|"), F.lit("/")))
    quotes = read(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", quote.alias("q")))), lambda x: x["q"]).alias("quotes"), F.collect_list(F.struct(F.trim(quote).alias("k"), "text")).alias("original"))
    empty = F.array().cast("array<string>")
    facts = MD.gold_inds(F.col("quotes"), F.array().cast("array<array<string>>"), empty, empty)
    found = quotes.select("conv_id", "original", F.explode(facts).alias("key", "quote"))
    return found.select("conv_id", "key", F.md5(F.filter("original", lambda o: o["k"] == F.col("quote"))[0]["text"]).alias("digest"))


@query(
    "q_segment_islands",
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
    k as (select *, case when contains(line, ' | ') then 'table' else 'text' end as kind from l where trim(line) <> ''),
    g as (select *, (kind is distinct from lag(kind) over (partition by doc_id order by pos))::int as fresh from k),
    i as (select *, sum(fresh) over (partition by doc_id order by pos) - 1 as island from g)
    select doc_id, island::bigint as island, any_value(kind) as kind, count(*) as n_lines from i group by doc_id, island""",
)
def segment_islands(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda x: F.when(F.contains(x, F.lit(" | ")), F.concat(F.lit("|"), x)).otherwise(F.regexp_replace(x, r"^\s*\|+", "/")))
    found = read(spark, d, "documents").select("doc_id", F.posexplode(MD.blocks(F.array_join(lines, "\n"))).alias("island", "b"))
    return found.select("doc_id", F.col("island").cast("long").alias("island"), "b.kind", F.size(F.split("b.text", "\n")).cast("long").alias("n_lines"))


@query("q_distinct_evidence", "select l_suppkey, count(distinct l_partkey) as n_chunks from lineitem group by l_suppkey")
def distinct_evidence(spark, d):
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_chunks"))


@query("q_next_slot", "select coalesce(max(try_cast(substr(c_name, 10) as bigint)), 0) + 1 as next_slot from customer where starts_with(c_name, 'Customer#')")
def next_slot(spark, d):
    return relational.next_slot(read(spark, d, "customer"), "c_name", "Customer#")


@query(
    "q_quota_fill_batch",
    """with c as (select doc_id, lang, source from documents qualify row_number() over (partition by source order by doc_id) <= 5)
    select doc_id, lang, source, row_number() over (partition by lang order by doc_id)::int as slot from c qualify row_number() over (partition by lang order by doc_id) <= 10""",
)
def quota_fill_batch(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang", "source")
    quotas = docs.select("lang").distinct().withColumn("quota", F.lit(10))
    return generation.filled_by_windows(docs, "lang", "source", "doc_id", quotas)


@query("q_quota_fill_rounds")
def quota_fill_rounds(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang", "source")
    quotas = docs.select("lang").distinct().withColumn("quota", F.lit(10))
    return generation.filled_by_rounds(docs, "lang", "source", "doc_id", quotas)


@query(
    "q_fixed_windows",
    f"""with w as (select doc_id, list_filter(string_split({COLLAPSED}, ' '), lambda x: x <> '') as w from documents),
    p as (select doc_id, w, unnest(range(0, greatest(ceil((len(w) - 50) / 400.0), 1)::bigint)) as pos from w where len(w) > 0)
    select doc_id, pos::int as pos, len(w[pos * 400 + 1 : pos * 400 + 450])::int as n_tokens, md5(array_to_string(w[pos * 400 + 1 : pos * 400 + 450], ' ')) as digest from p""",
)
def fixed_windows(spark, d):
    return chunking.windows(read(spark, d, "documents"), "doc_id", "text").select("doc_id", "pos", "n_tokens", F.md5("window").alias("digest"))


@query("q_paragraph_count", r"select page_id, len(regexp_extract_all(html, '<p[ >]'))::bigint as n_paragraphs from pages")
def paragraph_count(spark, d):
    return read(spark, d, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<p[ >]"), F.lit(0))).cast("long").alias("n_paragraphs"))


@query("q_index_replace", "select vec_id as chunk_id, label, case when label < 4 then 2 else 1 end as version from embeddings where label >= 4 or vec_id % 3 = 0")
def index_replace(spark, d):
    rows = read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label", F.lit(1).alias("version"))
    return index.replaced(rows, rows.filter("label < 4 and chunk_id % 3 = 0").withColumn("version", F.lit(2)), ("label",))


@query("q_index_upsert", "select vec_id as chunk_id, label, case when vec_id % 3 = 0 then 2 else 1 end as version from embeddings")
def index_upsert(spark, d):
    rows = read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label", F.lit(1).alias("version"))
    return index.upsert(rows, rows.filter("chunk_id % 3 = 0").withColumn("version", F.lit(2)))


@query("q_seeded_order", "select doc_id, md5('42#' || doc_id::varchar) as ord_key from documents")
def seeded_order(spark, d):
    return generation.shuffled(read(spark, d, "documents").select("doc_id"), "doc_id", 42)


@query("q_html_blocks")
def html_block_rows(spark, d):
    return markup.blocks(read(spark, d, "pages"), "page_id")


@query("q_chunks")
def chunk_rows(spark, d):
    docs = read(spark, d, "documents")
    sections = docs.select(
        F.col("source").alias("company"), F.lit(2024).alias("year"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("section"), F.lit(None).cast("string").alias("report_code"), MD.blocks(F.col("text")).alias("blocks")
    )
    return chunking.section_chunks(sections, "blocks")


@query("q_html_chunks")
def html_chunks(spark, d):
    """From markup to chunks: blocks are cut and packed where the page is."""
    pages = read(spark, d, "pages").select(F.lit("web").alias("company"), F.lit(2024).alias("year"), F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("section"), F.lit(None).cast("string").alias("report_code"), "html")
    return chunking.section_chunks(pages, "html", 256, 32)


@query("q_length_batches")
def length_batches(spark, d):
    return index.length_batches(read(spark, d, "documents"), "text", "doc_id")


@query("q_embed_hash")
def embed_hash(spark, d):
    return index.embedded(read(spark, d, "documents").select("doc_id", "text"), "text", prefix="passage: ").select("doc_id", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


@query(
    "q_finqa_item",
    f"""with t as (select conv_id, turn, text, list_filter(string_split(regexp_replace({COLLAPSED}, '([.!?。]) +', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') as s from conversations),
    p as (select conv_id, sum(len(s)) filter (trim(text) <> '')::int as n_pre, arg_min(text, turn) as question, arg_max(text, turn) as answer from t group by conv_id)
    select 'c' || conv_id::varchar as id, coalesce(n_pre, 0) as n_pre, 0 as n_post, '2024_A001' as filename, question, answer, try_cast(replace(regexp_extract(replace(answer, ' ', ''), '{NUM}', 0), ',', '') as double) as exe_ans_num from p""",
)
def finqa_item(spark, d):
    turns = read(spark, d, "conversations")
    items = turns.groupBy(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id")).agg(
        F.min_by("text", "turn").alias("question"),
        F.max_by("text", "turn").alias("gold_answer"),
        F.transform(F.array_sort(F.collect_list("turn")), lambda t: t.cast("string")).alias("turns"),
        F.count("*").cast("int").alias("reasoning_hops"),
        F.min("conv_id").alias("conv_id"),
    )
    items = items.withColumns(
        {
            "evidence_chunks": F.transform("turns", lambda t: F.concat_ws("_", F.col("conv_id").cast("string"), t)),
            "evidence_quotes": F.array("question"),
            "reasoning_steps": F.col("turns"),
            "source_report": F.lit("2024_A001"),
            "source_company": F.lit(""),
        }
    )
    chunks = turns.select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), "text")
    found = export.converted(items, chunks)
    return found.select("id", F.size("pre_text").alias("n_pre"), F.size("post_text").alias("n_post"), "filename", "qa.question", "qa.answer", "qa.exe_ans_num")


SIGNS = ("Ⅰ", "ⅱ", "Ⅲ", "IV", "5", "x")


@query(
    "q_headings",
    f"""with h as (select o_orderkey, ['{"', '".join(SIGNS)}'][o_custkey % 6 + 1] || '．  ' || o_orderpriority as h from orders),
    n as (select o_orderkey, trim(regexp_replace(replace(replace(replace(replace(h, 'Ⅰ', 'I'), 'ⅱ', 'II'), 'Ⅲ', 'III'), '．', '.'), ' +', ' ', 'g')) as heading from h)
    select o_orderkey, heading, case when regexp_matches(heading, '^[IVX]') then 'top' when regexp_matches(heading, '^[0-9]') then 'sub' end as kind, contains(replace(heading, ' ', ''), '.2-H') or contains(replace(heading, ' ', ''), 'II.1') as wanted from n""",
)
def headings(spark, d):
    signs = F.array(*map(F.lit, SIGNS))
    text = F.concat(F.get(signs, (F.col("o_custkey") % 6).cast("int")), F.lit("．  "), F.col("o_orderpriority"))
    heading = S.normalize_heading(text)
    return read(spark, d, "orders").select("o_orderkey", heading.alias("heading"), S.heading_kind(heading).alias("kind"), S.heading_matches(text, F.array(F.lit(". 2-H"), F.lit("II.1"))).alias("wanted"))


@query("q_clean_cells", "select p_partkey, trim(regexp_replace(p_name || ' / ' || p_type || ' ' || p_brand, ' +', ' ', 'g')) as cell from part")
def clean_cells(spark, d):
    cell = F.concat(F.lit("\n "), "p_name", F.lit(" | "), "p_type", F.lit(" \r\n"), "p_brand")
    return read(spark, d, "part").select("p_partkey", S.clean_cell(cell).alias("cell"))


@query(
    "q_markdown_cells",
    """with l as (select l_orderkey, l_linenumber, l_returnflag, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_returnflag = 'N', l_returnflag) as r from lineitem),
    w as (select l_orderkey, bool_or(l_returnflag = 'N') as wide from l group by l_orderkey),
    c as (select l_orderkey, r, case when l_returnflag = 'N' then ['', l_linenumber::varchar, '', ''] else [l_linenumber::varchar, l_returnflag] end as c from l),
    p as (select l_orderkey, r, case when wide and len(c) = 2 then list_concat(c, ['', '']) else c end as c from c join w using (l_orderkey))
    select l_orderkey, (r - 1)::int as r, (generate_subscripts(c, 1) - 1)::int as c, unnest(c) as cell from p""",
)
def markdown_cells(spark, d):
    """Tables of an order's lines as Markdown, with empty outer cells, a separator row and any line ends, taken apart into cells."""
    line = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("||"), F.col("l_linenumber").cast("string"), F.lit("|||"))).otherwise(F.concat(F.lit("  | "), F.col("l_linenumber").cast("string"), F.lit(" | "), "l_returnflag", F.lit("|")))
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    text = F.concat(F.get("lines", 0), F.lit("\r\n| --- | :--: |\nno line of it\r"), F.array_join(F.slice("lines", F.lit(2), F.size("lines")), "\n"))
    rows = lines.select("l_orderkey", F.posexplode(MD.parse_markdown_table(text)).alias("r", "cells"))
    return rows.select("l_orderkey", "r", F.posexplode("cells").alias("c", "cell"))


@query(
    "q_verify_drafts",
    """select conv_id, turn, case when turn % 4 = 3 then 'missing_fields' when turn % 3 = 2 then 'no_steps' when length(role) > 6 and turn % 2 = 0 then 'hops_differ_from_steps' when conv_id % 5 = 4 then 'unknown_evidence'
    when conv_id % 7 = 6 then 'blank_quote' when conv_id % 11 = 10 then 'quote_not_in_evidence' when conv_id % 3 = 2 then 'gold_not_a_single_value' else 'ok' end as verdict from conversations""",
)
def verify_drafts(spark, d):
    """Drafts whose faults come from their numbers, each with those that come after it in the order of the rules."""
    n, turn, chunk = F.col("conv_id"), F.col("turn"), F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    quote = F.when(n % 7 == 6, " ").when(n % 11 == 10, "no such words in any turn").otherwise(F.regexp_replace(F.substring("text", 1, 12), " ", "  "))
    fields = {
        "question": F.col("text"), "gold_answer_unit": F.lit("%"), "evidence_chunks": F.array(F.when(n % 5 == 4, "none").otherwise(chunk)), "evidence_quotes": F.array(quote),
        "reasoning_steps": F.array_repeat(F.lit("step"), F.when(turn % 3 == 2, 0).otherwise(2).cast("int")), "reasoning_hops": F.when((F.length("role") > 6) & (turn % 2 == 0), 3).otherwise(2),
    }
    body = F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))
    gold = F.when(n % 3 == 2, '["a", "b"]').otherwise('"a"')
    whole = F.concat(F.lit('{"gold_answer": '), gold, F.lit(", "), F.substr(body, F.lit(2)))
    reply = F.when(turn % 4 == 3, body).otherwise(whole)
    return read(spark, d, "conversations").select("conv_id", "turn", evidence.verified(reply, F.create_map(chunk, F.col("text"))).alias("verdict"))


@query(
    "q_report_codes",
    """with m as (select o_custkey as company, year(o_orderdate)::int as year, arg_max(o_orderpriority, o_orderkey) as report_code from orders where o_orderstatus <> 'P' group by all)
    select o_orderkey, o.o_custkey as company, year(o_orderdate)::int as year, report_code from orders o left join m on m.company = o.o_custkey and m.year = year(o_orderdate)::int""",
)
def report_codes(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("company"), F.year("o_orderdate").alias("year"), "o_orderstatus", F.col("o_orderpriority").alias("report_code"))
    return relational.with_report_codes(rows.drop("o_orderstatus", "report_code"), rows.filter("o_orderstatus != 'P'"), "o_orderkey")


@query(
    "q_receipts",
    """with m as (select o_custkey as company, year(o_orderdate)::int as year, max(o_orderkey)::varchar as rcept_no from orders group by all),
    i as (select event_id, user_id, (1992 + event_id % 8)::int as year from events)
    select event_id, rcept_no, 'https://viewer/' || rcept_no as link from i left join m on m.company = user_id and m.year = i.year""",
)
def receipts(spark, d):
    items = read(spark, d, "events").select("event_id", F.col("user_id").alias("source_company"), F.concat((F.col("event_id") % 8 + 1992).cast("string"), F.lit("_A001")).alias("source_report"))
    manifest = read(spark, d, "orders").select(F.col("o_custkey").alias("company"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").cast("string").alias("rcept_no"), "o_orderkey")
    return relational.with_receipts(items, manifest, "o_orderkey", "https://viewer/%s").select("event_id", "rcept_no", F.when(F.col("rcept_no").isNotNull(), F.col("link")).alias("link"))


@query(
    "q_wanted_reports",
    """select c_name as name, c_custkey::varchar as corp_code, y.year, t.code as report_code, t.i::int as preference from customer, (select distinct year(o_orderdate)::int as year from orders) y,
    (values ('A', 0), ('B', 1)) t(code, i)""",
)
def wanted_reports(spark, d):
    companies = read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("corp_code"))
    return relational.wanted_reports(companies, read(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct(), ["A", "B"])


@query("q_last_wins", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by event_id desc) = 1")
def last_wins(spark, d):
    return relational.last_wins(read(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("q_subset", "select p_partkey, p_brand from part where p_brand in (select min(p_brand) from part union all select max(p_brand) from part)")
def subset(spark, d):
    rows = read(spark, d, "part").select("p_partkey", "p_brand")
    ends = rows.agg(F.min("p_brand").alias("a"), F.max("p_brand").alias("b")).first()
    return relational.subset(rows, "p_brand", [ends.a, ends.b])


@query(
    "q_first_success",
    """select o_custkey as report, o_orderpriority as spec_id, o_orderstatus as strategy, o_orderkey as member_ord from orders where o_totalprice > 1e5
    qualify row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) = 1""",
)
def first_success(spark, d):
    hits = read(spark, d, "orders").filter("o_totalprice > 1e5").select(F.col("o_custkey").alias("report"), F.col("o_orderpriority").alias("spec_id"), F.col("o_orderstatus").alias("strategy"), F.col("o_orderkey").alias("member_ord"))
    return relational.first_by(hits, ["report", "spec_id"], F.col("member_ord"))


@query(
    "q_extraction_success",
    "select o_orderstatus as strategy, count(*) as n, (select greatest(count(*), 1) from orders) as total, round(count(*) * 1e0 / (select greatest(count(*), 1) from orders), 6) as share from orders where o_totalprice > 1e5 group by 1",
)
def extraction_success(spark, d):
    return sections.success(read(spark, d, "orders").select(F.col("o_orderstatus").alias("strategy"), (F.col("o_totalprice") > 1e5).alias("found")))


@query(
    "q_missed_gold",
    GOLD.rpartition(",\n    j as")[0] + " select question_id, array_to_string(list_sort(list_filter(gold, lambda x: not list_contains(found, x))), ',') as missed from gold join hits using (question_id) where len(list_filter(gold, lambda x: not list_contains(found, x))) > 0",
)
def missed_gold(spark, d):
    questions, chunks = _questions(spark, d), _chunks(spark, d)
    gold = index.top_k(questions, chunks, 3, ["label"]).groupBy("question_id").agg(F.collect_list("chunk_id").alias("gold"))
    found = index.missed(gold, index.top_k(questions.drop("label"), chunks.drop("label"), 15, []))
    return found.select("question_id", F.array_join(F.col("missed").cast("array<string>"), ",").alias("missed"))


@query(
    "q_second_pass_counts",
    f"""with d as ({ORACLES["q_second_pass_diff"]}),
    h as (select d.*, id % 3 <> 0 as a, id % 4 <> 0 as b from d)
    select count(*) filter (not (a and b)) as only_in_one, count(*) filter (a and b and status_changed) as status_changed, count(*) filter (a and b and changed <> '') as fields_changed,
    count(*) filter (not (a and b)) + count(*) filter (a and b and status_changed) + count(*) filter (a and b and changed <> '') as n_diff from h""",
)
def second_pass_counts(spark, d):
    return review.second_pass_counts(_passes(spark, d))


@query(
    "q_validation",
    """with r as (select l_orderkey, count(distinct l_returnflag) as kinds from lineitem group by 1)
    select count(*) as n, count(*) filter (kinds is not null) as with_table, count(*) filter (kinds > 1) as non_rectangular_tables, count(*) filter (o_orderstatus = 'P') as missing_exe_ans from orders left join r on l_orderkey = o_orderkey""",
)
def validation(spark, d):
    row = F.array_repeat(F.lit("cell"), F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).cast("int"))
    tables = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(row).alias("table"))
    items = read(spark, d, "orders").join(tables, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    qa = F.struct(F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).alias("exe_ans_num"), F.when(F.col("o_orderstatus") == "O", "text").otherwise("").alias("exe_ans_text"))
    return export.validated(items.select(F.coalesce("table", F.array().cast("array<array<string>>")).alias("table"), qa.alias("qa")))


VERDICT = "case l_returnflag when 'N' then 'ok' when 'A' then 'no_quotes' else 'no_json' end"


def _verdicts(spark, d):
    verdict = F.when(F.col("l_returnflag") == "N", "ok").when(F.col("l_returnflag") == "A", "no_quotes").otherwise("no_json")
    return read(spark, d, "lineitem").select(F.col("l_linenumber").cast("string").alias("task_type"), verdict.alias("verdict"))


@query("q_attempt_stats", f"select l_linenumber::varchar as task_type, count(*) as attempts, count(*) filter ({VERDICT} = 'ok') as successes, count(*) filter ({VERDICT} <> 'ok') as discards from lineitem group by 1")
def attempt_stats(spark, d):
    return generation.attempt_stats(_verdicts(spark, d))


@query("q_discard_reasons", f"select l_linenumber::varchar as task_type, {VERDICT} as reason, count(*) as n from lineitem where {VERDICT} <> 'ok' group by 1, 2")
def discard_reasons(spark, d):
    return generation.discard_reasons(_verdicts(spark, d))


@query("q_next_pending", "select coalesce(min(o_orderkey) filter (o_orderstatus = 'P' and o_orderkey > 100), min(o_orderkey) filter (o_orderstatus = 'P'), min(o_orderkey)) as ord from orders")
def next_pending(spark, d):
    return review.next_pending(read(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("accepted").alias("status")), 100)


@query("q_cursor_moves", "select c_custkey, greatest(0, least(c_custkey + c_nationkey - 12, (select count(*) from customer) - 1)) as position from customer")
def cursor_moves(spark, d):
    rows = read(spark, d, "customer")
    n = rows.agg(F.count("*").alias("n"))
    return rows.crossJoin(F.broadcast(n)).select("c_custkey", review.moved(F.col("c_custkey"), F.col("c_nationkey") - 12, F.col("n")).alias("position"))


@query("q_final_answer", "select conv_id, turn, trim(role) as answer from conversations")
def final_answer(spark, d):
    text = F.concat("text", F.lit("\n최종답: none of these\n최종답 ： "), "role", F.lit("  \n"))
    return read(spark, d, "conversations").select("conv_id", "turn", S.final_answer(text).alias("answer"))


@query("q_item_ids", "select p_partkey, printf('DART_T%d_%03d', p_size % 5 + 1, p_partkey) as id, printf('%s_%d_%s_%03d', p_brand, 2024, 'sec', p_partkey) as chunk_id from part")
def item_ids(spark, d):
    rows = read(spark, d, "part")
    return rows.select("p_partkey", S.item_id(F.concat(F.lit("T"), (F.col("p_size") % 5 + 1).cast("string")), F.col("p_partkey")).alias("id"), S.chunk_id(F.col("p_brand"), F.lit(2024), F.lit("sec"), F.col("p_partkey")).alias("chunk_id"))


@query("q_need_map", "select n_nationkey, 'T' || n_regionkey::varchar as task_type, n_nationkey as need from nation union all select n_nationkey, 'T9' as task_type, 2 as need from nation")
def need_map(spark, d):
    spec = F.concat(F.lit(" T"), F.col("n_regionkey").cast("string"), F.lit(" : "), F.col("n_nationkey").cast("string"), F.lit(",, T9:2"))
    return read(spark, d, "nation").select("n_nationkey", F.explode(S.need_map(spec)).alias("task_type", "need"))


@query(
    "q_quote_places",
    "select conv_id, turn, ((length(text) - length(replace(text, 'th', ''))) / 2)::int as n_spans, nullif(strpos(text, 'th'), 0)::int - 1 as first from conversations",
)
def quote_places(spark, d):
    spans = S.quote_spans(F.col("text"), F.array(F.lit("th"), F.lit("")))
    return read(spark, d, "conversations").select("conv_id", "turn", spans.alias("s")).select("conv_id", "turn", F.size("s").alias("n_spans"), F.get("s", 0)["start"].alias("first"))


@query(
    "q_evidence_blocks",
    """select conv_id, md5(string_agg('--- chunk_id=' || turn::varchar || ' | section=' || role || ' | has_table=' || case when contains(text, ',') then 'True' else 'False' end || ' ---' || chr(10) || text || chr(10), chr(10) order by turn)) as digest
    from conversations group by conv_id""",
)
def evidence_blocks(spark, d):
    chunk = F.struct("turn", F.col("turn").cast("string").alias("chunk_id"), "text", F.col("role").alias("section"), F.contains("text", F.lit(",")).alias("has_table"))
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(chunk)).alias("chunks")).select("conv_id", F.md5(evidence.block(F.col("chunks"))).alias("digest"))


@query("q_manifest_pool", "select o_orderkey, year(o_orderdate)::varchar || '_' || substr(coalesce(nullif(o_orderpriority, '5-LOW'), '?'), 1, 5) as label from orders where o_orderstatus in ('F', 'O')")
def manifest_pool(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "cached").otherwise("failed")
    rows = read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("report_code"), status.alias("status"))
    return files.manifest_pool(rows).select("o_orderkey", "label")


@query("q_index_get", "select vec_id as chunk_id, label from embeddings where vec_id in (select l_linenumber * 10 from lineitem)")
def index_get(spark, d):
    return index.by_ids(read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label"), read(spark, d, "lineitem").select((F.col("l_linenumber") * 10).cast("long").alias("chunk_id")))


@query("q_percent", "select o_custkey, printf('%.1f%%', count(*) filter (o_orderstatus = 'F') * 1e2 / count(*)) as share from orders group by 1")
def percent(spark, d):
    counts = read(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("k"), F.count("*").alias("n"))
    return counts.select("o_custkey", S.percent_of(F.col("k"), F.col("n")).alias("share"))


@query(
    "q_chunks_by_company",
    "select source as company, lang as year, count(*) as n_chunks, sum(n_chars)::bigint as n_tokens from documents group by all",
)
def chunks_by_company(spark, d):
    return grading.counted(read(spark, d, "documents").select(F.col("source").alias("company"), F.col("lang").alias("year"), F.col("n_chars").alias("token_count")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the documents by quality label: sentences, windows, tokens and a class by the share of full windows."""
    docs = read(spark, sf_dir, "documents")
    parts = chunking.windows(docs, "doc_id", "text", 100, 120)
    per_doc = grading.classified(parts, ["doc_id"], F.col("n_tokens") == 120)
    n_sentences = docs.select("doc_id", "lang", F.size(S.sentences(F.col("text"))).alias("n_sentences"))
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = per_doc.join(n_sentences, "doc_id").join(labels, "doc_id", "left")
    return joined.groupBy("lang", "quality", "classification").agg(F.count("*").alias("n_docs"), F.sum("n_sentences").alias("n_sentences"), F.sum("n_attempts").alias("n_windows"))
