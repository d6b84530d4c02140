"""Queries of the operators that keep state, stores or an index of their own, with the SQL that gives the same rows."""

from __future__ import annotations

import json
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkquill.operators import attempts, generation, index, ivf, limiter, markup, quotas, relational, review, stored_index
from sparkquill.plans import catalog
from sparkquill.plans.catalog import Query, read
from sparkquill.shared import new_path
from sparkquill.sources import filings, zips
from sparkquill.streaming import reviews

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# a collection with inverted lists

#: Lists of the collection, and how many of them a question probes.
LISTS, PROBES, NEAREST = 16, 13, 20


def _collection(spark: SparkSession, d: str) -> tuple[DataFrame, ivf.Collection]:
    chunks = read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("v"), "label")
    questions = read(spark, d, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("q"), "label")
    return questions, ivf.build(chunks, new_path(spark, "collection"), LISTS, rounds=6)


@query("q_ivf_all_lists", catalog._topk_sql("true", NEAREST))  # noqa: SLF001
def ivf_all_lists(spark, d):
    questions, collection = _collection(spark, d)
    return collection.query(questions, NEAREST, LISTS)


@query("q_ivf_filtered", catalog._topk_sql("q.label = v.label", NEAREST))  # noqa: SLF001
def ivf_filtered(spark, d):
    questions, collection = _collection(spark, d)
    return collection.query(questions, NEAREST, LISTS, ["label"])


@query("q_ivf_recall", "select count(*) as n_questions, true as reached from embeddings where vec_id % 50 = 0")
def ivf_recall(spark, d):
    """Whether the mean recall of the 20 nearest, against all chunks, is 0.9 at least."""
    return recalls(spark, d).agg(F.count("*").alias("n_questions"), (F.avg("recall") >= 0.9).alias("reached"))


def recalls(spark: SparkSession, d: str, n_probe: int = PROBES) -> DataFrame:
    """(question_id, recall): the share of the 20 nearest chunks that probing finds."""
    questions, collection = _collection(spark, d)
    chunks = catalog._chunks(spark, d).drop("label")  # noqa: SLF001
    found = collection.query(questions.drop("label"), NEAREST, n_probe).select("question_id", "chunk_id", F.lit(1).alias("hit"))
    wanted = index.top_k(questions.drop("label"), chunks, NEAREST, []).select("question_id", "chunk_id")
    return wanted.join(found, ["question_id", "chunk_id"], "left").groupBy("question_id").agg((F.count("hit") / F.count("*")).alias("recall"))


# limits, quotas, attempts


@query(
    "q_rate_limited",
    """with recursive n as (select user_id, event_id, epoch_us(ts) as us, row_number() over (partition by user_id order by ts, event_id) - 1 as i from events),
    r as (select user_id, event_id, i, us, us as start from n where i < 3 union all
      select n.user_id, n.event_id, n.i, n.us, greatest(n.us, r.start + 100000000000) from r join n on n.user_id = r.user_id and n.i = r.i + 3)
    select event_id, start as start_us, round((start - us) / 1e6, 6) as waited from r""",
)
def rate_limited(spark, d):
    """Events as calls: of each user three begin within 100,000 seconds at most."""
    found = limiter.admitted(read(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", 3, 100_000)
    return found.select("event_id", F.unix_micros("start").alias("start_us"), F.round("waited", 6).alias("waited"))


@query(
    "q_quota_fill_exact",
    """with recursive s as (select source, row_number() over (order by md5('42#' || source)) - 1 as place from (select distinct source from documents where source is not null)),
    p as (select count(*) as size, (select ceil(count(*) / 450)::int from documents) as cap from s),
    q as (select lang, row_number() over (order by lang) - 1 as turn, count(*) // 20 as quota from documents where lang is not null group by lang),
    c as (select turn, place, doc_id, n_chars > 900 as good, row_number() over (partition by turn, place order by doc_id) as nth from documents join s using (source) join q using (lang)),
    st as (select 0 as turn, 0 as visit, 0 as done, (select list_transform(range(size), lambda x: 0::int) from p) as used, null::bigint as pick, 0 as seen
      union all
      select case when stop then turn + 1 else turn end, case when stop then 0 else visit + 1 end, case when stop then 0 when hit then done + 1 else done end,
        case when hit then list_transform(used, lambda x, i: case when i = visit % size + 1 then x + 1 else x end) else used end, case when hit then doc_id end, visit
      from (select st.turn, st.visit, st.done, st.used, p.size, c.doc_id, (st.done >= q.quota or st.visit >= q.quota * 5) as stop,
          not (st.done >= q.quota or st.visit >= q.quota * 5) and coalesce(c.good, false) and st.used[st.visit % p.size + 1] < p.cap as hit
        from st cross join p join q on q.turn = st.turn left join c on c.turn = st.turn and c.place = st.visit % p.size and c.nth = st.visit // p.size + 1))
    select lang, doc_id, done::bigint as slot, seen::bigint as visit from st join documents on doc_id = pick""",
)
def quota_fill_exact(spark, d):
    """Documents as candidates: a twentieth of each language, going round the sources in a seeded order, some per source at most."""
    docs = read(spark, d, "documents").filter("lang is not null").select("doc_id", "lang", "source", "n_chars")
    seeded = F.md5(F.concat(F.lit("42#"), "source"))
    names = [r.source for r in docs.filter("source is not null").select("source").distinct().orderBy(seeded).collect()]  # the pool is configuration
    pool = spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "source string, position long")
    counts = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    total = read(spark, d, "documents").count()
    wanted = [(k, n // 20) for k, n in sorted(counts.items())]
    return quotas.filled(docs, pool, wanted, F.col("n_chars") > 900, "lang", "source", "doc_id", -(-total // 450)).select("lang", "doc_id", "slot", "visit")


def recorded(call: dict, number: int) -> tuple[str, int, int]:
    """A provider of recorded outcomes: the try behind ``fails`` failures is the first that answers."""
    if number <= call["fails"]:
        raise ConnectionError("recorded failure")
    return call["answer"], len(call["answer"]), 1


@query(
    "q_attempt_ledger",
    """with c as (select o_orderkey, o_orderstatus || '-' || o_orderpriority as answer, floor(o_totalprice)::bigint % 6 as fails from orders)
    select o_orderkey, least(fails + 1, 4)::int as tries, case when fails < 4 then answer else '' end as raw, (case when fails < 4 then length(answer) else 0 end)::bigint as input_tokens, fails >= 4 as failed from c""",
)
def attempt_ledger(spark, d):
    """Orders as calls, of which some fail several times. Delays are passed over, as time is not what is asked."""
    calls = read(spark, d, "orders").select("o_orderkey", F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("answer"), (F.floor("o_totalprice") % 6).alias("fails"))
    found = attempts.called(calls, ["o_orderkey"], recorded, new_path(spark, "ledger"), wait=lambda s: None, clock=lambda: 0.0)
    return found.select("o_orderkey", "tries", "raw", "input_tokens", F.col("error").isNotNull().alias("failed"))


# stored index, filings, reviews

@query(
    "q_stored_index",
    """with old as (select vec_id, label, embedding[1]::double as x from embeddings),
    new as (select vec_id + 7 as vec_id, label + 100 as label, embedding[2]::double as x from embeddings where label = 3)
    select vec_id, label, x from old where vec_id not in (select vec_id from new) and label <> 5 union all select * from new
    where vec_id not in (select vec_id from old where label = 5)""",
)
def stored(spark, d):
    """An index in three versions: all rows, some of them replaced by key with new ones added, and those of one label removed."""
    rows = read(spark, d, "embeddings").select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    held = stored_index.Index.create(spark, new_path(spark, "index"), rows.select("vec_id", "label", "x").schema, ["vec_id"], 16)
    held.upsert(rows.select("vec_id", "label", "x"))
    gone = held.read().filter("label = 5").select("vec_id")
    held.upsert(rows.filter("label = 3").select(F.col("vec_id") + 7, F.col("label") + 100, "y").toDF("vec_id", "label", "x"))
    held.delete(gone)
    return held.read()


@query(
    "q_filing_pages",
    """with o as (select n_nationkey as corp, n_name as corp_name, year(o_orderdate) as y, o_orderkey, strftime(o_orderdate, '%Y%m%d') as rcept_dt, o_orderpriority
      from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)
    select lpad(corp::varchar, 8, '0') as corp_code, y::varchar || '0101' as bgn_de, ((row_number() over (partition by corp, y order by o_orderkey) - 1) // 50 + 1)::int as page_no,
    o_orderkey::varchar as rcept_no, corp_name, o_orderpriority as report_nm, rcept_dt from o""",
)
def filing_pages(spark, d):
    """Orders as filings of nations by year, recorded as the service's pages of 50 and read back page after page."""
    answers, requests = _recorded_lists(spark, d)
    path = new_path(spark, "recorded")
    filings.record(answers, path)
    spark.dataSource.register(filings.FilingList)
    found = spark.read.format("filing_list").option("requests", requests).option("path", path).load()
    return found.select("corp_code", "bgn_de", "page_no", "rcept_no", "corp_name", "report_nm", "rcept_dt")


def _recorded_lists(spark: SparkSession, d: str, size: int = 50) -> tuple[DataFrame, str]:
    orders = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(read(spark, d, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))
    code = F.lpad(F.col("n_nationkey").cast("string"), 8, "0")
    rows = orders.select(code.alias("corp_code"), F.year("o_orderdate").alias("y"), "o_orderkey", F.struct(F.col("o_orderkey").cast("string").alias("rcept_no"), code.alias("corp_code"), F.col("n_name").alias("corp_name"), F.col("o_orderpriority").alias("report_nm"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt")).alias("row"))
    numbered = rows.withColumn("i", F.row_number().over(Window.partitionBy("corp_code", "y").orderBy("o_orderkey")) - 1)
    page = numbered.groupBy("corp_code", "y", F.floor(F.col("i") / size).alias("p")).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "row"))), lambda x: x["row"]).alias("list"))
    total = numbered.groupBy("corp_code", "y").agg(F.ceil(F.count("*") / size).alias("total_page"))
    body = F.to_json(F.struct(F.lit("000").alias("status"), F.lit("ok").alias("message"), F.col("total_page").cast("int").alias("total_page"), "list"))
    held = page.join(total, ["corp_code", "y"]).select("corp_code", "y", (F.col("p") + 1).cast("int").alias("page_no"), body.alias("body"))
    years = [r.y for r in orders.select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]
    nations = [r.n_nationkey for r in read(spark, d, "nation").select("n_nationkey").collect()]
    asked = [{"corp_code": f"{n:08d}", "bgn_de": f"{y}0101", "end_de": f"{y}1231"} for n in nations for y in [*years, max(years, default=2000) + 1]]
    pairs = spark.createDataFrame([(a["corp_code"], a["bgn_de"], a["end_de"], int(a["bgn_de"][:4])) for a in asked], "corp_code string, bgn_de string, end_de string, y int")
    none = F.lit('{"status": "013", "message": "no data"}')
    answered = pairs.join(held, ["corp_code", "y"], "left").select(
        F.lit(filings.LIST).alias("endpoint"), "corp_code", "bgn_de", "end_de", F.lit(None).cast("string").alias("pblntf_detail_ty"), F.lit(None).cast("string").alias("rcept_no"),
        F.coalesce("page_no", F.lit(1)).alias("page_no"), F.lit(200).alias("status_code"), F.lit("application/json").alias("content_type"), F.coalesce("body", none).cast("binary").alias("body"),
    )
    return answered, json.dumps(asked)


@query(
    "q_report_cascade",
    """with l as (select l_orderkey as id, l_linenumber as rank, min(l_discount) > 0.03 as bad, min(l_returnflag) <> 'N' as found, min(l_partkey) as part, max(l_linestatus) = 'F' as cached, max(l_tax) > 0.06 as broken
      from lineitem where l_linenumber <= 4 group by 1, 2),
    e as (select * from l where found and not bad qualify row_number() over (partition by id order by rank) = 1),
    b as (select l.id, max(l.rank) as listed from l left join e on e.id = l.id where l.bad and (e.rank is null or l.rank < e.rank) group by l.id)
    select k.id, 'C' || e.rank as report_code, e.part::varchar as rcept_no, case when e.id is null then 'missing' when e.cached then 'cached' when e.broken then 'error' else 'downloaded' end as status,
    case when not e.cached and e.broken then 'download_error:broken' when b.listed is not null then 'list_error:E' || b.listed when e.id is null then 'no_matching_report_in_year' end as reason
    from (select distinct id from l) k left join e on e.id = k.id left join b on b.id = k.id""",
)
def report_cascade(spark, d):
    """Lines of an order as tries of report codes: some lists fail, some hold no report, some downloads fail."""
    lines = read(spark, d, "lineitem").filter("l_linenumber <= 4").groupBy(F.col("l_orderkey").alias("id"), "l_linenumber")
    lines = lines.agg((F.min("l_discount") > 0.03).alias("bad"), (F.min("l_returnflag") != "N").alias("found"), F.min("l_partkey").alias("part"), (F.max("l_linestatus") == "F").alias("cached"), (F.max("l_tax") > 0.06).alias("broken"))
    named = lambda prefix: F.concat(F.lit(prefix), F.col("l_linenumber").cast("string"))
    tries = lines.select(
        "id", named("C").alias("report_code"), F.when(F.col("bad"), named("E")).alias("list_error"), F.when(~F.col("bad") & F.col("found"), F.col("part").cast("string")).alias("rcept_no"),
        F.lit("report").alias("report_nm"), F.lit("file").alias("file"), "cached", F.lit(False).alias("dry_run"), F.when(F.col("broken"), "broken").alias("download_error"),
    )
    return relational.cascade(tries, ["id"], ["C1", "C2", "C3", "C4"]).select("id", "report_code", "rcept_no", "status", "reason")


@query("q_review_stream", catalog.ORACLES["q_review_states"])
def review_stream(spark, d):
    """Events as review actions that come as a stream; the states are those that all actions give at once."""
    events, path = read(spark, d, "events"), new_path(spark, "reviews")
    action = F.when(F.col("event_type") == "click", "accept").when(F.col("event_type") == "view", "discard").when(F.col("event_type") == "purchase", "edit").otherwise("regenerate")
    actions = events.select(F.col("event_id").alias("ord"), F.col("ts").cast("string").alias("ts"), F.col("user_id").cast("string").alias("id"), action.alias("action"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note"))
    actions.repartition(6, "ts").write.parquet(f"{path}/actions")
    actions = spark.readStream.schema(actions.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/actions")
    with reviews.rocksdb(spark):
        reviews.kept(actions, f"{path}/states", f"{path}/checkpoint").awaitTermination()
    items = read(spark, d, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_custkey").cast("string").alias("id"))
    changed = spark.read.schema(reviews.CHANGE).option("basePath", f"{path}/states").parquet(f"{path}/states")
    return reviews.latest(items, changed).select(F.col("id").cast("long").alias("id"), "status", "discard_reason")


# archives, batches by length, statistics of drafts


#: Bytes of texts in an archive, about; a task packs one or a few archives.
ARCHIVE = 16 << 20


@query("q_zip_members", "select doc_id, strlen(coalesce(text, ''))::bigint as n_bytes, sha256(coalesce(text, '')) as digest from documents")
def zip_members(spark, d):
    """Documents packed into archives, written as streams by the tasks, and read back member by member."""
    path = new_path(spark, "zips")
    docs = read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    archives = max(24, -(-n_bytes // ARCHIVE))
    docs = docs.withColumn("archive", F.pmod(F.xxhash64("doc_id"), F.lit(archives)).cast("int"))

    def pack(frames):
        name, stream, held = None, None, None
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        for frame in frames:
            for doc_id, text, archive in frame.itertuples(index=False):
                if archive != name:
                    if held:
                        held.close()
                        stream.close()
                    name, stream = archive, store.open_output_stream(f"{folder}/{archive:03d}.zip")
                    held = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                held.writestr(f"{doc_id}.xml", text)
            yield pd.DataFrame({"n": [len(frame)]})
        if held:
            held.close()
            stream.close()

    docs.repartition(archives, "archive").sortWithinPartitions("archive").mapInPandas(pack, "n long").write.format("noop").mode("overwrite").save()
    found = zips.contents(zips.members(zips.listing(spark, path), ".xml"))
    doc_id = F.regexp_extract("member", r"^(-?[0-9]+)\.xml$", 1).cast("long")
    return found.select(doc_id.alias("doc_id"), F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("digest"))


@query(
    "q_embed_by_length",
    """select doc_id, greatest(len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '')), 1)::int as n_tokens, true as bounded from documents""",
)
def embed_by_length(spark, d):
    """Documents with their vectors, encoded in batches of like lengths; whether each batch keeps its bounds."""
    found = index.embedded_by_length(read(spark, d, "documents"), "doc_id", "text")
    bounded = (F.col("n_texts") <= 32) & ((F.col("n_texts") == 1) | (F.col("n_texts") * F.col("padded") <= 6144)) & (F.size("embedding") == 64)
    return found.select("doc_id", "n_tokens", bounded.alias("bounded"))


@query(
    "q_draft_stats",
    """with i as (select l_returnflag as t, l_linestatus as c, l_suppkey::varchar as r, l_linenumber as hops, [l_partkey, l_suppkey] as e from lineitem),
    n as (select t, c, r, grouping(t) as gt, grouping(c) as gc, count(*) as n_items, round(avg(hops), 6) as mean_hops from i group by grouping sets ((t), (c, r), ())),
    k as (select t, c, r, count(distinct x) as n_chunks from (select t, c, r, unnest(e) as x from i) group by grouping sets ((t), (c, r), ()))
    select case when gt = 0 then 'type' when gc = 0 then 'report' else 'all' end as level, n.t as task_type, n.c as source_company, n.r as source_report, n_items, mean_hops, n_chunks
    from n join k on n.t is not distinct from k.t and n.c is not distinct from k.c and n.r is not distinct from k.r""",
)
def draft_stats(spark, d):
    items = read(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("task_type"), F.col("l_linestatus").alias("source_company"), F.col("l_suppkey").cast("string").alias("source_report"), F.col("l_linenumber").alias("reasoning_hops"), F.array("l_partkey", "l_suppkey").alias("evidence_chunks")
    )
    return generation.draft_stats(items)


# markup as events


@query(
    "q_html_tables",
    """with o as (select c_custkey, c_name, o_orderkey, o_orderstatus, o_orderpriority from customer join orders on o_custkey = c_custkey),
    t as (select c_custkey, c_name, '| order | status | status |' || chr(10) || '| --- | --- | --- |' || chr(10) ||
      string_agg('| ' || o_orderkey || ' | ' || o_orderstatus || ' | ' || replace(o_orderpriority, '-', '/') || ' |', chr(10) order by o_orderkey) as markdown from o group by all)
    select c_custkey, 0 as pos, 'text' as kind, 'Orders of ' || c_name || ' & co' as payload from t union all
    select c_custkey, 1, 'table', markdown from t union all select c_custkey, 2, 'text', 'end of ' || c_custkey from t""",
)
def html_tables(spark, d):
    """Pages with a table of each customer's orders, and text before and behind it; the head's second cell spans two columns."""
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("<td><i>"), "o_orderstatus", F.lit("</i><td>\n"), F.replace("o_orderpriority", F.lit("-"), F.lit("|")), F.lit(" </tr>"))
    orders = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    pages = read(spark, d, "customer").join(orders, "c_custkey")
    head = F.concat(F.lit("<style>p{}</style><p>Orders  of <b>"), "c_name", F.lit("</b> &amp; co<table><tbody><tr><th>order<th colspan=2>status</tr>"))
    tail = F.concat(F.lit("</table><script>no</script><p>end<br>of "), F.col("c_custkey").cast("string"))
    return markup.blocks(pages.select("c_custkey", F.concat(head, "rows", tail).alias("html")), "c_custkey")


@query(
    "q_sections",
    """select c_custkey, 'overview' as spec_id, case when c_mktsegment = 'BUILDING' then 'structured' else 'textual' end as strategy,
    case when c_mktsegment = 'BUILDING' then 'of ' || c_name || chr(10) || '<p>' || c_nationkey || '</p>' else '<p>of ' || c_name || '</p>' || chr(10) || '<table><tr><td>' || c_nationkey || '</td></tr></table>' end as html
    from customer where c_mktsegment <> 'MACHINERY'""",
)
def report_sections(spark, d):
    """Reports of customers: nested sections in one segment, headings among paragraphs in others, and none that is wanted in one."""
    name, nation = F.col("c_name"), F.col("c_nationkey").cast("string")
    nested = F.concat(F.lit("<doc><section-1><title>Ⅱ. 사업의  내용</title><section-2><title>2. 제품</title>x</section-2><section-2><title>1. 사업의 개요</title>of "), name, F.lit("<p>"), nation, F.lit("</p></section-2></section-1></doc>"))
    top = F.when(F.col("c_mktsegment") == "MACHINERY", "III. 재무에 관한 사항").otherwise("II. 사업의 내용")
    flat = F.concat(F.lit("<p>before</p><h2>"), top, F.lit("</h2><p>1. 사업의 개요<p>of "), name, F.lit("</p><div><table><tr><td>"), nation, F.lit("</table></div><p>2. 제품<p>behind"))
    reports = read(spark, d, "customer").select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", nested).otherwise(flat).alias("html"))
    specs = spark.createDataFrame([("overview", ["사업의 내용"], ["사업의 개요"])], "id string, parents array<string>, titles array<string>")
    return markup.sections(reports, "c_custkey", specs)
