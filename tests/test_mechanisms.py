"""Operators that keep state, stores or an index of their own, against brute force and after failures."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkquill.operators import attempts, index, ivf, limiter, nearest, ordered, quotas, relational, review, stored_index
from sparkquill.shared import new_path
from sparkquill.sources import filings
from sparkquill.streaming import limits, reviews

# running totals and limits


def test_running_totals_of_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(("hot",) * 6 + ("b", None)), i, rng.choice((None, 1, 2, -3, 5))) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(5)
    found = ordered.running(df, ["k"], ["i"], {"c": ("count", F.col("v")), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, parts=9)
    assert found.columns == ["k", "i", "v", "c", "s", "m"]
    held = defaultdict(list)
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        known = [x for x in [*held[k], v] if x is not None]
        held[k].append(v)
        assert found.filter("1 = 1") is not None
        held[k, i] = (len(known), sum(known) if known else None, max(known) if known else None)
    assert {(r.k, r.i): (r.c, r.s, r.m) for r in found.collect()} == {x: y for x, y in held.items() if isinstance(x, tuple)}
    whole = ordered.running(df, [], ["i"], {"c": ("count", F.lit(1))}, parts=7)
    assert sorted(r.c for r in whole.collect()) == list(range(1, 401))
    assert ordered.running(df.limit(0), ["k"], ["i"], {"c": ("count", F.lit(1))}).count() == 0


def limit_brute(calls, most, seconds):
    starts, out = defaultdict(list), {}
    for key, at, i in sorted((c for c in calls if c[1] is not None), key=lambda c: (c[1], c[2])):
        own = starts[key]
        own.append(max(at, own[-most] + seconds * 1_000_000) if len(own) >= most else at)
        out[i] = own[-1]
    return out


def calls_table(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice(("hot",) * 5 + ("b", "c", None)), rng.choice((None, *[rng.randrange(600) * 1_000_000] * 30)), i) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, us long, i long").withColumn("ts", F.timestamp_micros("us")).drop("us")
    return rows, df


@pytest.mark.parametrize(("most", "seconds"), [(1, 7), (3, 60), (4, 0)])
def test_limit(spark, most, seconds):
    rows, calls = calls_table(spark)
    found = limiter.admitted(calls, "key", "ts", "i", most, seconds, parts=6).withColumn("us", F.unix_micros("start")).collect()
    assert len(found) == len(rows)
    want = limit_brute(rows, most, seconds)
    assert {r.i: r.us for r in found if r.us is not None} == want
    assert all((r.us is None) == (dict((i, at) for _, at, i in rows)[r.i] is None) for r in found)
    arrival = {i: at for _, at, i in rows}
    assert all(abs(r.waited - (r.us - arrival[r.i]) / 1e6) < 1e-9 for r in found if r.us is not None)
    with pytest.raises(ValueError):
        limiter.admitted(calls, "key", "ts", "i", 0, 1)


@pytest.mark.parametrize("batches", [1, 4])
def test_limit_of_a_stream_does_not_depend_on_batches(spark, batches):
    rows, calls = calls_table(spark, 120, 8)
    calls = calls.filter("key is not null")
    path = new_path(spark, "limits")
    ordered_rows = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2]))
    size = -(-len(ordered_rows) // batches)
    stream, found = None, []
    with reviews.rocksdb(spark):
        for b in range(batches):
            part = spark.createDataFrame(ordered_rows[b * size : (b + 1) * size], "key string, us long, i long").withColumn("ts", F.timestamp_micros("us")).drop("us")
            part.coalesce(1).write.mode("append").parquet(f"{path}/in")
            stream = limits.limited(spark.readStream.schema(part.schema).parquet(f"{path}/in"), "key", "ts", "i", 2, 60)
            query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
            query.awaitTermination()
    found = spark.read.parquet(f"{path}/out").withColumn("us", F.unix_micros("start")).collect()
    assert {r.i: r.us for r in found} == limit_brute(ordered_rows, 2, 60)
    assert len(found) == len(ordered_rows)


# quotas


def fill_brute(rows, pool, wanted, cap, extra):
    used, out = Counter(), []
    for kind, quota in wanted:
        queue = defaultdict(list)
        for r in sorted(rows, key=lambda r: r[2]):
            if r[0] == kind:
                queue[r[1]].append(r)
        done = 0
        for visit in range(quota * extra):
            if done == quota or not pool:
                break
            source = pool[visit % len(pool)]
            if used[source] >= cap:
                continue
            drawn = queue[source].pop(0) if queue[source] else None
            if drawn and drawn[3]:
                done += 1
                used[source] += 1
                out.append((drawn[2], done, visit))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_quota_fill_is_the_sequence(spark, seed):
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(rng.choice((1, 3, 8)))]
    rows = [(rng.choice("ABCX"), rng.choice([*sources, "hot", "hot"]), i, rng.choice((True, True, False, None))) for i in range(rng.choice((20, 200)))]
    pool = [*sources, "hot", "empty"]
    rng.shuffle(pool)
    wanted = [("B", 7), ("A", 12), ("C", 5), ("D", 2), ("B", 0)]
    df = spark.createDataFrame(rows, "kind string, source string, ord long, good boolean").repartition(3)
    places = spark.createDataFrame(list(zip(pool, range(len(pool)), strict=True)), "source string, position long")
    found = quotas.filled(df, places, wanted, F.col("good"), cap=3, extra=4)
    assert found.columns == ["kind", "source", "ord", "good", "slot", "visit"]
    assert sorted((r.ord, r.slot, r.visit) for r in found.collect()) == sorted(fill_brute(rows, pool, wanted, 3, 4))


def test_quota_fill_of_nothing(spark):
    df = spark.createDataFrame([], "kind string, source string, ord long")
    places = spark.createDataFrame([("a", 0)], "source string, position long")
    assert quotas.filled(df, places, [("A", 3)], F.lit(True)).count() == 0
    assert quotas.filled(df, places.limit(0), [("A", 3)], F.lit(True)).count() == 0
    assert quotas.filled(df, places, [], F.lit(True)).columns == ["kind", "source", "ord", "slot", "visit"]


# nearest


def nearest_brute(questions, chunks, k, keyed):
    out = {}
    for q, x, a in questions:
        if x is None:
            continue
        near = [(round(sum((float(s) - float(t)) ** 2 for s, t in zip(x, v, strict=True)), 9), c) for c, v, b in chunks if v is not None and len(v) == len(x) and (not keyed or (a is not None and a == b))]
        out[q] = [c for _, c in sorted(near)[:k]]
    return {q: c for q, c in out.items() if c}


def vectors_table(spark, n=500, seed=2):
    rng = np.random.default_rng(seed)
    same = [1.0, 0.0, 0.5, 0.25]
    chunks = [(i, same if i % 3 == 0 else rng.integers(0, 3, 4).astype(float).tolist() if i % 3 == 1 else rng.normal(size=4).tolist(), "hot" if rng.random() < 0.9 else rng.choice(["b", "c"]).item()) for i in range(n)]
    chunks += [(n, None, "hot"), (n + 1, [1.0, 2.0], "hot"), (n + 2, same, None)]
    questions = [(i, rng.normal(size=4).tolist(), "hot") for i in range(4)] + [(4, same, "hot"), (5, same, "b"), (6, same, "none"), (7, None, "hot"), (8, same, None), (9, [0.5, 1.0], "hot")]
    return questions, chunks, spark.createDataFrame(questions, "question_id long, q array<double>, key string"), spark.createDataFrame(chunks, "chunk_id long, v array<double>, key string").repartition(6)


@pytest.mark.parametrize(("keyed", "most"), [(False, 10_000), (True, 10_000), (True, 3)])
def test_nearest(spark, keyed, most):
    questions, chunks, q, c = vectors_table(spark)
    found = nearest.top_k(q, c, 7, ["key"] if keyed else [], most).orderBy("question_id", "rank").collect()
    got = defaultdict(list)
    for r in found:
        got[r.question_id].append(r.chunk_id)
    assert dict(got) == nearest_brute(questions, chunks, 7, keyed)


def test_nearest_shuffles_few_rows_of_a_hot_key(spark):
    _, _, q, c = vectors_table(spark, 3000)
    sent = nearest.candidates(q, c, 5, ["key"])
    tasks = c.rdd.getNumPartitions()
    equal = sent.groupBy("question_id", "distance").count().agg(F.max("count")).first()[0]
    assert equal <= 5 * tasks
    assert sent.count() <= q.count() * tasks * 5 * 2
    assert "Join" not in sent._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def clusters(n=3000, k=24, d=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(k, d)) * 3
    return [(i, (centres[i % k] + rng.normal(size=d) * 0.4).tolist(), i % 2) for i in range(n)]


def test_inverted_lists(spark, monkeypatch):
    rows = clusters()
    chunks = spark.createDataFrame(rows, "chunk_id long, v array<float>, label int").repartition(5)
    questions = chunks.filter("chunk_id % 50 = 0").select(F.col("chunk_id").alias("question_id"), F.col("v").alias("q"), "label")
    built = ivf.build(chunks, new_path(spark, "collection"), 24, rounds=8, rows_per_file=100)
    held = ivf.opened(spark, built.path)
    assert np.array_equal(held.centroids, built.centroids)
    assert held.rows().count() == len(rows)
    # the same centroids however the table is cut
    assert np.array_equal(ivf.fit(chunks.repartition(3), 24, rounds=8), built.centroids)
    pairs = lambda df: {(r.question_id, r.chunk_id, r.rank) for r in df.collect()}
    exact = nearest.top_k(questions.drop("label"), chunks, 20)
    assert pairs(held.query(questions.drop("label"), 20, 24)) == pairs(exact)
    assert pairs(held.query(questions, 20, 24, ["label"])) == pairs(nearest.top_k(questions, chunks, 20, ["label"]))
    few = pairs(held.query(questions.drop("label"), 20, 3))
    wanted = {(q, c) for q, c, _ in pairs(exact)}
    assert len({(q, c) for q, c, _ in few} & wanted) / len(wanted) >= 0.9
    plan = held.query(questions.limit(1).drop("label"), 5, 2)
    assert plan.count() == 5


def test_inverted_lists_of_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 0.0]) for i in range(10)] + [(400, None), (401, [1.0])]
    chunks = spark.createDataFrame(rows, "chunk_id long, v array<double>")
    built = ivf.build(chunks, new_path(spark, "collection"), 4, rows_per_file=50)
    assert built.rows().count() == 310
    q = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [1.0])], "question_id long, q array<double>")
    assert [(r.question_id, r.chunk_id) for r in built.query(q, 3, 4).orderBy("rank").collect()] == [(1, 0), (1, 1), (1, 2)]
    with pytest.raises(ValueError):
        ivf.fit(chunks.limit(0), 4)


# attempts


def failing(log):
    """A provider that notes each call in a file and fails as often as the call says."""

    def call(row, number):
        with open(f"{log}/{row['id']}", "a") as file:
            file.write(f"{number}\n")
        if number <= row["fails"]:
            raise TimeoutError("not now")
        return f"answer {row['id']}", 10, 2

    return call


def test_attempts_back_off_and_resume(spark, tmp_path):
    log, ledger = tmp_path / "log", new_path(spark, "ledger")
    log.mkdir()
    rows = [(i, i % 6) for i in range(30)]
    calls = spark.createDataFrame(rows, "id long, fails int")
    now, waited = [1000.0], []

    def wait(seconds):
        waited.append(round(seconds, 6))
        now[0] += seconds

    def run(policy=attempts.ANSWERS, df=calls):
        return {r.id: r for r in attempts.called(df, ["id"], failing(str(log)), ledger, policy, buckets=5, wait=wait, clock=lambda: 1000.0).collect()}

    # tasks keep one time, so that delays show: after 1, 2 and 3 failures 1, 2 and 4 seconds
    found = run()
    assert {i: (r.tries, r.raw, r.error is None) for i, r in found.items()} == {i: (min(f + 1, 4), f"answer {i}" if f < 4 else "", f < 4) for i, f in rows}
    assert all((r.input_tokens, r.output_tokens) == ((10, 2) if r.error is None else (0, 0)) for r in found.values())
    assert waited[:3] == [1.0, 2.0, 4.0]
    count = lambda: {i: len((log / str(i)).read_text().split()) for i, _ in rows}
    assert count() == {i: min(f + 1, 4) for i, f in rows}
    # a second run calls nothing; more tries go on where they ended
    assert run() == found
    assert count() == {i: min(f + 1, 4) for i, f in rows}
    more = run(attempts.Policy(tries=6))
    assert all(r.error is None for r in more.values())
    assert count() == {i: f + 1 for i, f in rows}


def test_attempts_of_a_lost_task_are_not_repeated(spark, tmp_path):
    log, ledger = tmp_path / "log", new_path(spark, "ledger")
    log.mkdir()
    calls = spark.createDataFrame([(i, 0) for i in range(12)], "id long, fails int")
    # a journal as a lost task leaves it: outcomes, and a line cut off
    bucket = {r.id: r.b for r in calls.withColumn("b", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(2))).collect()}
    for b in (0, 1):
        journal = attempts.Journal(ledger, b)
        for i in [i for i in range(6) if bucket[i] == b]:
            journal.add([str(i)], {"try": 1, "at": 1.0, "raw": "kept", "input_tokens": 1, "output_tokens": 1, "error": None})
        journal.out.write(b'{"key": ["7"], "try": 1, "raw": "to')
        journal.close()
    found = attempts.called(calls, ["id"], failing(str(log)), ledger, buckets=2, wait=lambda s: None)
    assert {r.id: r.raw for r in found.collect()} == {i: "kept" if i < 6 else f"answer {i}" for i in range(12)}
    assert sorted(int(f.name) for f in log.iterdir()) == list(range(6, 12))


def test_attempts_read_the_ledger_once(spark, tmp_path, monkeypatch):
    log, read = tmp_path / "log", []
    log.mkdir()
    whole = attempts.outcomes
    monkeypatch.setattr(attempts, "outcomes", lambda *a: read.append(1) or whole(*a))
    rows = [(i, i % 6, None if i % 2 else 2**60 + i) for i in range(30)]
    calls = spark.createDataFrame(rows, "id long, fails int, big long")
    found = attempts.called(calls, ["id"], failing(str(log)), new_path(spark, "ledger"), buckets=3, wait=lambda s: None, clock=lambda: 0.0).collect()
    assert sorted((r.id, r.fails, r.big, r.tries, r.error is None) for r in found) == [(*r, min(r[1] + 1, 4), r[1] < 4) for r in rows]
    # rounds go on from what the round before gave
    assert len(read) == 1


def test_attempts_that_may_not_fail(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    calls = spark.createDataFrame([(1, 9), (2, 0)], "id long, fails int")
    with pytest.raises(attempts.Exhausted, match="TimeoutError"):
        attempts.called(calls, ["id"], failing(str(log)), new_path(spark, "ledger"), attempts.EMBEDDINGS, wait=lambda s: None, clock=lambda: 1.0)
    assert len((log / "1").read_text().split()) == 5
    assert [attempts.ANSWERS.delay(n) for n in range(6)] == [0, 1, 2, 4, 8, 8]
    assert attempts.EMBEDDINGS.delay(6) == 32


# stored index


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, x double")


def test_stored_index(spark):
    held = stored_index.Index.create(spark, new_path(spark, "index"), table(spark, []).schema, ["id"], 8)
    assert held.read().count() == 0
    model = {i: (i, f"p{i % 3}", float(i)) for i in range(40)}
    held.upsert(table(spark, list(model.values())))
    first = held.read()
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(first) == sorted(model.values())
    changed = [(3, "p9", -1.0), (100, "p1", 2.0), (3, "p9", -2.0)]
    held.upsert(table(spark, changed), order="x")
    new = model | {3: (3, "p9", -1.0), 100: (100, "p1", 2.0)}
    assert rows(held.read()) == sorted(new.values())
    # only touched buckets are written, and the old version is still there
    data = held.commit()["data"]
    assert 1 <= sum(c != held.commit(1)["data"].get(b) for b, c in data.items()) <= 2
    assert rows(first) == rows(held.read(1)) == sorted(model.values())
    assert rows(held.lookup(table(spark, [(3, "", 0.0), (7, "", 0.0), (999, "", 0.0)]))) == sorted([new[3], new[7]])
    held.replace(table(spark, [(200, "p1", 5.0), (4, "p1", 6.0)]), ["part"])
    new = {i: r for i, r in new.items() if r[1] != "p1"} | {200: (200, "p1", 5.0), 4: (4, "p1", 6.0)}
    assert rows(held.read()) == sorted(new.values())
    held.delete(table(spark, [(200, "", 0.0), (5, "", 0.0), (12345, "", 0.0)]))
    new = {i: r for i, r in new.items() if i not in (200, 5)}
    assert rows(held.read()) == sorted(new.values())
    assert held.versions() == [0, 1, 2, 3, 4]
    assert held.vacuum(2)
    assert held.versions() == [3, 4]
    assert rows(held.read()) == sorted(new.values())
    held.reset()
    assert held.read().count() == 0
    held.upsert(table(spark, [(None, "n", 1.0), (None, "n", 1.0)]))
    assert held.read().count() == 1


def test_stored_index_after_an_aborted_write(spark, monkeypatch):
    held = stored_index.Index.create(spark, new_path(spark, "index"), table(spark, []).schema, ["id"], 4)
    held.upsert(table(spark, [(1, "a", 1.0)]))
    other = stored_index.Index(spark, held.path)

    def stop(*_):
        raise OSError("the writer is gone")

    with monkeypatch.context() as broken:
        broken.setattr(other.files, "publish", stop)
        with pytest.raises(OSError, match="gone"):
            other.upsert(table(spark, [(1, "b", 2.0), (2, "b", 2.0)]))
    assert [tuple(r) for r in held.read().collect()] == [(1, "a", 1.0)]
    # of two writers of one version the second fails, and may try again
    stale = held.commit()
    other.upsert(table(spark, [(2, "c", 3.0)]))
    with monkeypatch.context() as late:
        late.setattr(held, "commit", lambda version=None: stale)
        with pytest.raises(stored_index.Conflict):
            held.upsert(table(spark, [(3, "d", 4.0)]))
    held.upsert(table(spark, [(3, "d", 4.0)]))
    assert sorted(r.id for r in held.read().collect()) == [1, 2, 3]
    assert len(held.vacuum(1)) >= 2
    with pytest.raises(stored_index.Conflict):
        stored_index.Index.create(spark, held.path, table(spark, []).schema, ["id"]) and held._commit(held.versions()[-1], stale)  # noqa: SLF001


# filings


def answer(corp, page, body, status=200, kind="application/json", endpoint=filings.LIST, rcept=None):
    year = None if endpoint == filings.DOCUMENT else "2024"
    return (endpoint, corp, year and f"{year}0101", year and f"{year}1231", None, rcept, page, status, kind, bytearray(body if isinstance(body, bytes) else json.dumps(body).encode()))


ANSWERS = "endpoint string, corp_code string, bgn_de string, end_de string, pblntf_detail_ty string, rcept_no string, page_no int, status_code int, content_type string, body binary"


def listed(corp, page, total, n):
    rows = [{"rcept_no": f"{corp}-{page}-{i}", "corp_code": corp, "corp_name": "n", "report_nm": "r"} for i in range(n)]
    return {"status": "000", "message": "ok", "total_page": total, "list": rows}


def test_filing_lists_and_documents(spark):
    recorded = [answer("A", p, listed("A", p, 3, 2 if p < 3 else 1)) for p in (1, 2, 3)]
    recorded += [answer("B", 1, {"status": "013", "message": "none"}), answer("C", 1, {"status": "020", "message": "too many"}), answer("D", 1, listed("D", 1, 2, 1)), answer("D", 2, {"status": "800", "message": "down"})]
    recorded += [answer(None, None, b"PK\x03\x04zip", kind="text/html", endpoint=filings.DOCUMENT, rcept="1"), answer(None, None, b"any", kind="application/zip", endpoint=filings.DOCUMENT, rcept="2")]
    recorded += [answer(None, None, b"<r><status>014</status><message>no file</message></r>", kind="text/xml", endpoint=filings.DOCUMENT, rcept="3"), answer(None, None, b"oops", kind="text/plain", endpoint=filings.DOCUMENT, rcept="4")]
    path = new_path(spark, "recorded")
    filings.record(spark.createDataFrame(recorded, ANSWERS), path)
    for source in (filings.FilingList, filings.FilingDocuments):
        spark.dataSource.register(source)

    def lists(corps, **more):
        asked = json.dumps([{"corp_code": c, "bgn_de": "20240101", "end_de": "20241231"} for c in corps])
        return spark.read.format("filing_list").options(requests=asked, path=path, tries=1, **more).load()

    found = lists("AB")
    assert found.rdd.getNumPartitions() == 2
    assert sorted((r.ord, r.page_no, r.rcept_no) for r in found.collect()) == [(0, 1, "A-1-0"), (1, 1, "A-1-1"), (2, 2, "A-2-0"), (3, 2, "A-2-1"), (4, 3, "A-3-0")]
    with pytest.raises(Exception, match="error 020: too many"):
        lists("AC").collect()
    # a request fails as a whole: no rows of the pages before
    kept = lists("ACDX", errors="rows", partitions=1).collect()
    assert {(r.asked_corp, r.error) for r in kept if r.error} == {("C", "list.json error 020: too many"), ("D", "list.json error 800: down"), ("X", "HTTP 404: not recorded")}
    assert sum(r.error is None for r in kept) == 5
    assert lists("").count() == 0
    asked = json.dumps([{"rcept_no": str(i)} for i in (1, 2, 3, 4)])
    got = {r.rcept_no: (bytes(r.content) if r.content else None, r.error) for r in spark.read.format("filing_documents").options(requests=asked, path=path, errors="rows").load().collect()}
    assert got == {"1": (b"PK\x03\x04zip", None), "2": (b"any", None), "3": (None, "document.xml error 014: no file"), "4": (None, "no archive: oops")}


def test_a_request_holds_one_page_at_a_time(tmp_path):
    import base64
    import tracemalloc
    import zlib

    params = {"corp_code": "A", "bgn_de": "20240101", "end_de": "20241231"}
    name = filings.request_name(filings.LIST, params)
    folder = tmp_path / f"bucket={zlib.crc32(name.encode()) % filings.RECORDED_BUCKETS}"
    folder.mkdir()
    with (folder / "part.json").open("w") as file:
        for page in range(1, 41):
            rows = [{"rcept_no": f"{page}-{i}", "corp_code": "A", "corp_name": "n" * 1000, "report_nm": "r"} for i in range(400)]
            body = base64.b64encode(json.dumps({"status": "000", "total_page": 40, "list": rows}).encode()).decode()
            # another request of the bucket has the same pages
            file.writelines(json.dumps({"name": n, "page_no": page, "status_code": 200, "content_type": "t", "body": body}, separators=(",", ":")) + "\n" for n in (name, "other"))
    for errors in ("raise", "rows"):
        reader = filings.FilingList({"requests": json.dumps([params]), "path": str(tmp_path), "errors": errors}).reader(None)
        tracemalloc.start()
        rows = [r[6] for r in reader.read(reader.partitions()[0])]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == [f"{page}-{i}" for page in range(1, 41) for i in range(400)]
        assert peak < 20 << 20, (errors, peak)


def test_requests_are_made_again():
    waited, made = [], []

    def outcomes(*held):
        left = list(held)

        def call():
            made.append(1)
            one = left.pop(0)
            if isinstance(one, Exception):
                raise one
            return filings.Answer(one, "t", b"body")

        return call

    assert filings.retried(outcomes(ConnectionError("x"), 503, TimeoutError("y"), 200), wait=waited.append).status_code == 200
    assert waited == [1, 2, 4]
    with pytest.raises(filings.SourceError, match="HTTP 500"):
        filings.retried(outcomes(*[500] * 9), wait=waited.append)
    assert waited[3:] == [1, 2, 4, 8]
    made.clear()
    with pytest.raises(filings.SourceError, match="HTTP 403: body"):
        filings.retried(outcomes(403), wait=waited.append)
    assert len(made) == 1
    with pytest.raises(ConnectionError):
        filings.retried(outcomes(*[ConnectionError("z")] * 7), tries=7, wait=waited.append)
    assert waited[-1] == 20


# cascade


def cascade_brute(rows, preference, compat=False):
    out = {}
    for key in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == key}
        row, reason = (None, None, None, None, "missing"), None
        for code in preference:
            if code not in own:
                continue
            _, _, list_error, rcept, name, file, cached, dry, broken = own[code]
            if list_error is not None:
                reason = f"list_error:{list_error}"
                continue
            if rcept is None:
                continue
            status = "cached" if cached else "dry_run" if dry else "error" if broken else "downloaded"
            row = (code, rcept, name, file if status in ("cached", "downloaded") else None, status)
            if status == "error":
                reason = f"download_error:{broken}"
            break
        else:
            reason = "no_matching_report_in_year" if compat or reason is None else reason
        out[key] = (*row, reason)
    return out


@pytest.mark.parametrize("compat", [False, True])
def test_cascade(spark, compat):
    rng = random.Random(6)
    rows = [(k, c, rng.choice((None, None, "e" + c)), rng.choice((None, "r" + c, "r" + c)), "nm", "f", rng.choice((True, False, None)), rng.choice((True, False, None)), rng.choice((None, "b" + c))) for k in range(120) for c in rng.sample(["A", "B", "C", "Z"], rng.randint(1, 4))]
    df = spark.createDataFrame(rows, "key long, report_code string, list_error string, rcept_no string, report_nm string, file string, cached boolean, dry_run boolean, download_error string")
    found = relational.cascade(df, ["key"], ["B", "A", "C"], compat).collect()
    assert {r.key: tuple(r)[1:] for r in found} == cascade_brute(rows, ["B", "A", "C"], compat)


# reviews


@pytest.mark.parametrize("batches", [1, 3])
def test_review_stream_is_the_batch(spark, batches):
    rng = random.Random(4)
    actions = [(i, f"t{i}", f"i{rng.randrange(9)}", rng.choice(("accept", "Edit", "discard", "regenerate")), rng.choice((None, "why"))) for i in range(60)]
    schema = "ord long, ts string, id string, action string, note string"
    mixed = actions + rng.sample(actions, 15)  # some come twice
    rng.shuffle(mixed)
    items = spark.createDataFrame([(i, f"i{i}") for i in range(11)], "ord long, id string")
    path = new_path(spark, "reviews")
    with reviews.rocksdb(spark):
        for b in range(batches):
            spark.createDataFrame(mixed[b::batches], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
            reviews.kept(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/states", f"{path}/check").awaitTermination()
    changed = spark.read.schema(reviews.CHANGE).parquet(f"{path}/states")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(reviews.latest(items, changed)) == rows(review.states(items, spark.createDataFrame(actions, schema)))


def test_index_top_k_is_the_two_phase_one(spark):
    questions, chunks, q, c = vectors_table(spark, 60)
    assert {(r.question_id, r.chunk_id) for r in index.top_k(q, c, 3, ["key"]).collect()} == {(i, x) for i, own in nearest_brute(questions, chunks, 3, True).items() for x in own}


# archives


def archive_bytes(kind):
    import io
    import zipfile

    buffer = io.BytesIO()
    if kind == "prefixed":
        buffer.write(b"#!/bin/sh\n" + b"x" * 777)

    class Stream(io.RawIOBase):  # as a pipe: sizes follow the data
        def writable(self):
            return True

        def write(self, data):
            buffer.write(data)
            return len(data)

    target = Stream() if kind == "streamed" else buffer
    with zipfile.ZipFile(target, "a" if kind == "prefixed" else "w", zipfile.ZIP_STORED if kind == "stored" else zipfile.ZIP_DEFLATED) as archive:
        for name, text in (("a.xml", "alpha " * 9000), ("dir/", ""), ("dir/b.XML", "é한" * 50), ("note.txt", "no"), ("empty.xml", ""), ("한.xml", "name")):
            if kind == "large" and text:
                with archive.open(zipfile.ZipInfo(name), "w", force_zip64=True) as file:
                    file.write(text.encode())
            else:
                archive.writestr(name, text)
        if kind == "comment":
            archive.comment = b"c" * 300
    return buffer.getvalue()


@pytest.mark.parametrize("kind", ["deflated", "stored", "streamed", "prefixed", "large", "comment"])
def test_archive_members(spark, tmp_path, kind):
    import io
    import zipfile

    from sparkquill.sources import files, zips

    data = archive_bytes(kind)
    (tmp_path / "x.zip").write_bytes(data)
    (tmp_path / "y.zip").write_bytes(archive_bytes("deflated"))
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        want = [(n, archive.read(n)) for n in archive.namelist() if n.lower().endswith(".xml")]
    found = zips.contents(zips.members(zips.listing(spark, str(tmp_path)), ".xml")).filter("path like '%x.zip'").orderBy("member_ord").collect()
    assert [(r.member, bytes(r.content), r.member_ord) for r in found] == [(n, c, i) for i, (n, c) in enumerate(want)]
    texts = files.archives(spark, str(tmp_path)).filter("report like '%x.zip'").orderBy("member_ord").collect()
    assert [(r.member, r.markup) for r in texts] == [(n, c.decode()) for n, c in want]
    # the directory is read from the end, and a member by its own range
    reads = []

    def read(at, n):
        reads.append((at, n))
        return data[at : at + n]

    members = zips.directory(read, len(data))
    assert [m.name for m in members if m.name.lower().endswith(".xml")] == [n for n, _ in want]
    if kind == "comment":  # signatures within the comment
        for cut in (10, 30, 200):
            odd = data[:-cut] + b"PK\x05\x06" + data[len(data) - cut + 4 :]
            assert zips.directory(lambda at, n: odd[at : at + n], len(odd)) == members  # noqa: B023
    reads.clear()
    last = [m for m in members if m.name == "한.xml"][0]
    assert zips.content(read, last) == b"name"
    assert sum(n for _, n in reads) < 200


def test_archives_that_are_none(spark, tmp_path):
    from sparkquill.sources import zips

    good = archive_bytes("deflated")
    for data in (b"", b"no archive", good[:-30]):
        with pytest.raises(zips.BadArchive):
            zips.directory(lambda at, n, data=data: data[at : at + n], len(data))
    members = zips.directory(lambda at, n: good[at : at + n], len(good))
    broken = bytearray(good)
    broken[members[0].start + 40] ^= 0xFF
    with pytest.raises((zips.BadArchive, Exception)):
        zips.content(lambda at, n: bytes(broken[at : at + n]), members[0])


# batches by length, blocks, statistics


def test_vectors_do_not_depend_on_batches(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice((0, 1, 5, 5, 5, 40, 300))))) for i in range(150)] + [(150, None)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    found = index.embedded_by_length(df, "id", "t", prefix="p: ", batch_size=8, max_tokens=200, parts=3, size=16).collect()
    want = {r.id: list(r.embedding) for r in index.embedded(df, "t", prefix="p: ", size=16).collect()}
    assert {r.id: list(r.embedding) for r in found} == want
    assert len(found) == len(rows)
    held = defaultdict(list)
    for r in found:
        held[r.batch].append(r)
    for own in held.values():
        assert len(own) <= 8 and (len(own) == 1 or len(own) * max(r.n_tokens for r in own) <= 200)
        assert {r.padded for r in own} == {max(r.n_tokens for r in own)}
        assert {r.n_texts for r in own} == {len(own)}
    # padded tokens stay near the real ones; in the order of ids they are twice as many
    waste = sum(r.padded for r in found) / sum(r.n_tokens for r in found)
    assert waste < 1.25


def test_long_texts_fill_more_parts_than_short_ones(spark):
    rows = [(i, "a " * 10) for i in range(900)] + [(900 + i, "b " * (500 + i)) for i in range(100)] + [(1000, None), (1001, " \n\x0b ")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    found = index.embedded_by_length(df, "id", "t", parts=8, size=16).collect()
    assert {r.id: r.n_tokens for r in found} == {i: len((t or "").split()) or 1 for i, t in rows} and len(found) == len(rows)
    tokens, lengths = Counter(), defaultdict(set)
    for r in found:
        tokens[r.batch.split("-")[0]] += r.n_tokens
        lengths[r.batch.split("-")[0]].add(r.n_tokens)
    # by equal numbers of rows one part of eight has most of the tokens
    assert len(tokens) == 8 and max(tokens.values()) < 1.6 * sum(tokens.values()) / 8
    spans = sorted((min(own), max(own)) for own in lengths.values())
    assert all(low >= high / 1.07 for (_, high), (low, _) in zip(spans, spans[1:], strict=False))  # ranges of length, but for a step that two share
    assert index.embedded_by_length(df.limit(0), "id", "t").count() == 0


def test_more_parts_where_they_would_hold_too_many_tokens(spark, monkeypatch):
    monkeypatch.setattr(index, "PART_TOKENS", 100)
    df = spark.createDataFrame([(i, "a b c d e") for i in range(400)], "id long, t string")
    assert index.embedded_by_length(df, "id", "t", size=4).rdd.getNumPartitions() >= 20


def test_vectors_of_words_beyond_those_kept(monkeypatch):
    text = " ".join(f"W{i % 60}" for i in range(200)) + " É é ß x  "
    want = [0.0] * 16
    for word in text.split():
        at, sign = index.word_place(word, 16)
        want[at] += sign
    norm = sum(x * x for x in want) ** 0.5
    for most in (1 << 18, 7):
        monkeypatch.setattr(index, "MOST_PLACES", most)
        index.places.cache_clear()
        assert index.hash_vector(text, 16) == [x / norm for x in want]
        assert len(index.places(16)) <= most
    assert index.hash_vector(" ", 16) == [0.0] * 16


def test_blocks_are_linear(spark):
    import time

    from sparkquill.functions import tables

    text = "\n".join(("| a | b |" if i // 3 % 2 else f"line {i}") for i in range(64_000))
    df = spark.createDataFrame([(text,)], "t string")
    began = time.perf_counter()
    n = df.select(F.size(tables.blocks(F.col("t"))).alias("n")).first().n
    assert n == -(-64_000 // 3)
    assert time.perf_counter() - began < 15
    odd = spark.createDataFrame([(None,), ("",), (" \n\n ",), ("| x |\n\n| y |\ntext",)], "t string").select(tables.blocks(F.col("t")).alias("b")).collect()
    assert [None if r.b is None else [(x.kind, x.text) for x in r.b] for r in odd] == [None, [], [], [("table", "| x |\n| y |"), ("text", "text")]]


def test_tables_of_wide_spans_stay_small():
    import time

    from sparkquill.operators import html_blocks

    html = "<table>" + "<tr><td rowspan=9999 colspan=1000>x</td><td>tail</td></tr>" * 200 + "</table>"
    began = time.perf_counter()
    found = html_blocks.blocks(html)
    assert time.perf_counter() - began < 10
    assert found[0][1].count("tail") == 200


def test_draft_stats(spark):
    from sparkquill.operators import generation

    rows = [("T1", "a", "r1", 2, ["x", "y"]), ("T1", "b", "r1", 3, ["x"]), ("T2", "a", "r1", None, []), ("T2", None, "r1", 4, None)]
    df = spark.createDataFrame(rows, "task_type string, source_company string, source_report string, reasoning_hops int, evidence_chunks array<string>")
    got = {(r.level, r.task_type, r.source_company, r.source_report): (r.n_items, r.mean_hops, r.n_chunks) for r in generation.draft_stats(df).collect()}
    assert got == {
        ("type", "T1", None, None): (2, 2.5, 2), ("type", "T2", None, None): (2, 4.0, 0), ("report", None, "a", "r1"): (2, 2.0, 2),
        ("report", None, "b", "r1"): (1, 3.0, 1), ("report", None, None, "r1"): (1, 4.0, 0), ("all", None, None, None): (4, 3.0, 2),
    }
    assert generation.draft_stats(df.limit(0)).count() == 0


def test_first_pass_is_put_aside_once(spark, tmp_path):
    place, aside = tmp_path / "reviewed.json", tmp_path / "first.json"
    assert not review.archive_first_pass(spark, str(place), str(aside))
    place.write_text("one")
    assert review.archive_first_pass(spark, str(place), str(aside))
    place.write_text("two")
    assert not review.archive_first_pass(spark, str(place), str(aside))
    assert (aside.read_text(), place.read_text()) == ("one", "two")


def test_next_slot_of_long_numbers(spark):
    ids = spark.createDataFrame([("T_" + "0" * 30 + "41",), ("T_7",), ("T_x",)], "id string")
    assert relational.next_slot(ids, "id", "T_").first()[0] == 42


def test_calibration_with_a_ledger(spark, tmp_path):
    from sparkquill.operators import grading

    log = tmp_path / "log"
    log.mkdir()
    items = spark.createDataFrame([(0, "i1", "T1", "q1", "10"), (1, "i2", "T1", "q2", "20")], "ord long, id string, task_type string, question string, gold_answer string")
    shown = spark.createDataFrame([("i1", "text")], "id string, evidence string")

    def provider(question, evidence):
        n = len(list(log.glob(f"{question}-*")))
        (log / f"{question}-{n}").write_text("")
        if question == "q1" and n < 2:
            raise ConnectionError("not yet")
        if question == "q2":
            raise ConnectionError("never")
        return "\ucd5c\uc885\ub2f5: 10", 5, 1

    run = lambda **more: grading.calibrated(items, shown, provider, 1, ledger=ledger, wait=lambda s: None, **more).collect()
    ledger = new_path(spark, "ledger")
    found = run()
    assert [(r.id, r.classification, r.attempts[0].raw != "", r.attempts[0].error) for r in found] == [("i1", "too_easy", True, None), ("i2", "too_hard", False, "ConnectionError: never")]
    assert (len(list(log.glob("q1-*"))), len(list(log.glob("q2-*")))) == (3, 4)
    assert run() == found and len(list(log.iterdir())) == 7


def test_patient_provider():
    waited, left = [], [1, 1, 0]

    def encode(texts):
        if left and left.pop(0):
            raise TimeoutError("busy")
        return [[1.0]] * len(texts)

    assert index.patient(encode, wait=waited.append)(["a", "b"]) == [[1.0], [1.0]]
    assert waited == [1, 2]
    left[:] = [1] * 9
    with pytest.raises(attempts.Exhausted, match="2 texts failed 5 times"):
        index.patient(encode, wait=waited.append)(["a", "b"])
    assert waited[2:] == [1, 2, 4, 8]


# files


def test_one_json_file_is_written_row_after_row(spark, tmp_path):
    from sparkquill.sources import files

    rows = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, F.lit('quote " and \n')).alias("t")).repartition(7)
    files.write_json_array(rows, str(tmp_path / "a.json"), order=["id"])
    assert json.loads((tmp_path / "a.json").read_text()) == [{"id": i, "t": 'quote " and \n' if i % 2 == 0 else None} for i in range(3000)]
    files.write_json_array(rows.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    states = spark.createDataFrame([], "ord long, item struct<id:string>, status string")
    files.save_reviewed(states, str(tmp_path / "r.json"), 'a "time"')
    assert json.loads((tmp_path / "r.json").read_text()) == {"saved_at": 'a "time"', "states": [], "items": []}
    some = spark.createDataFrame([(1, ("x",), "discarded")], states.schema)
    files.save_reviewed(some, str(tmp_path / "r.json"), "t")
    assert json.loads((tmp_path / "r.json").read_text()) == {"saved_at": "t", "states": [{"item": {"id": "x"}, "status": "discarded"}], "items": []}


def test_configuration_file(spark, tmp_path):
    pytest.importorskip("yaml")
    from sparkquill.sources import files

    (tmp_path / "c.yaml").write_text("companies:\n  - {name: a, corp_code: 126, stock: 5930, sector: s}\nsections:\n  - {id: x, parent_patterns: [p], title_patterns: [t, u]}\n")
    companies, sections = files.config_tables(spark, files.config(spark, str(tmp_path / "c.yaml")))
    assert [tuple(r) for r in companies.select("name", "corp_code", "stock").collect()] == [("a", "00000126", "005930")]
    assert [tuple(r) for r in sections.collect()] == [("x", ["p"], ["t", "u"])]
    with pytest.raises(FileNotFoundError):
        files.config(spark, str(tmp_path / "none.yaml"))


def test_distances_of_many_questions_are_not_held_at_once():
    import tracemalloc

    rng = np.random.default_rng(5)
    asked, vectors = rng.normal(size=(6000, 8)), rng.normal(size=(2048, 8))
    best = nearest.Best(len(asked), 3)
    tracemalloc.start()
    best.offer(np.arange(len(asked)), asked, np.arange(len(vectors)).astype(object), vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20, peak
    for i in (0, 511, 512, 5999):
        assert set(best.names[i].tolist()) >= set(np.argsort(nearest.exact(vectors, asked[i]))[:3].tolist())


def test_review_states_are_kept_without_python(spark):
    path = new_path(spark, "reviews")
    schema = "ord long, ts string, id string, action string, note string"
    spark.createDataFrame([(1, "t", "i", "Edit", None), (2, "u", "i", "accept", "n"), (2, "u", "i", "accept", "n")], schema).write.parquet(f"{path}/in")
    stream = reviews.changes(spark.readStream.schema(schema).parquet(f"{path}/in"))
    assert "Pandas" not in stream._jdf.queryExecution().analyzed().toString()  # noqa: SLF001
    with reviews.rocksdb(spark):
        reviews.kept(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/states", f"{path}/check").awaitTermination()
    assert [tuple(r)[:5] for r in spark.read.schema(reviews.CHANGE).parquet(f"{path}/states").collect()] == [("i", 2, "u", "accept", "n")]


def test_archives_grow_in_number(spark, tmp_path, monkeypatch):
    from sparkquill.plans import mechanisms

    spark.createDataFrame([(i, "x" * 1000) for i in range(200)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(mechanisms, "ARCHIVE", 2000, raising=False)
    path, whole = str(tmp_path / "zips"), mechanisms.zips.listing
    monkeypatch.setattr(mechanisms, "new_path", lambda *_: f"file://{path}")
    assert mechanisms.zip_members(spark, str(tmp_path)).count() == 200
    assert whole(spark, f"file://{path}").count() > 24
