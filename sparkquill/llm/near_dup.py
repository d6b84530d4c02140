"""MinHash near-duplicates with circulant permutations, exact verification and connected components.

Signatures: shingle hashes fall on a universe of ``UNIVERSE`` places. One permutation scatters them; a second one, shifted
circularly by 0, 1, 2, ... places, gives all coordinates, so a shingle contributes one contiguous slice of that table.
Bands of ``ROWS`` coordinates propose candidates; their number is such that a pair at the threshold is missed with a
probability of ``MISS`` at most. Every link is confirmed on the full shingle sets.

Groups are never expanded into pairs. Texts of one shingle set are one class, aggregated before the shuffle. In each
bucket every class is compared with one leader, the class that meets most others in its buckets; links become
components. Buckets that still hold several components are searched for the rest exactly. Their classes get one ruler,
the set C of the highest leader that any of them has met, and H, the shingles outside C that more than ``HOT`` classes of
that ruler hold. Sets x and y share at most min(|x & C|, |y & C|) + min(|x & H|, |y & H|) of C and H, so a linked pair
either reaches the threshold by that bound alone (an equi-join on steps of the set sizes that allow it) or shares a shingle outside
both (an equi-join on those shingles, which makes ``HOT`` rows at most for each of its input's). Neither join meets all
pairs of a group of copies. Pairs whose sizes do not allow a link are left out, and so
are those whose one-bit signatures differ in more places than a linked pair's do with a probability of ``MISS``.

Defined results: a text without words, or null, has the empty set, is linked with nothing and is its own component; a
text of fewer words than a shingle is one shingle; very long texts are read whole, in a batch of their own; rows that
repeat a doc_id and its text get the same answer, and one of them stays at most; of rows that share a doc_id only, each is
judged by its own text; a row without a doc_id is linked with nothing and kept; an empty table gives an empty result; extra
columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill.llm import words
from sparkquill.llm.columns import fresh, own
from sparkquill.llm.components import components
from sparkquill.shared import stored

UNIVERSE = 1 << 20
ROWS = 5
MISS = 1e-9
HOT = 64
#: Steps of set sizes between a size and the largest that may be linked with it.
STEPS = 16
#: Ids of texts to fetch or to drop that are broadcast at most, 8 or 16 bytes each.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    least: int = 80  #: per cent of the union that the intersection must reach
    rows: int = ROWS
    seed: int = 1

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.least / 100) ** self.rows))

    @property
    def smallest(self) -> int:
        """The least set size that can be linked with another set."""
        return math.ceil(self.least / max(1, 100 - self.least) - 1e-9)

    @property
    def most_bits(self) -> int:
        """One-bit coordinates that may differ: at the threshold more do with a probability of MISS at most."""
        n, p = self.bands * self.rows, (1 - self.least / 100) / 2
        tail, k = 1.0, -1
        while tail > MISS:
            k += 1
            tail -= math.comb(n, k) * p**k * (1 - p) ** (n - k)
        return k


@cache
def permutations(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows of the circular one: row s has the coordinates of place s."""
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(UNIVERSE)
    ring = rng.permutation(UNIVERSE).astype(np.uint32)
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([ring[-(size - 1) :], ring]), size)


def bands(shingles: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes of one set of shingle hashes, and the lowest bits of its coordinates in words of 64."""
    n = params.bands * params.rows
    scatter, ring = permutations(n, params.seed)
    places = scatter[(shingles >> np.uint64(44)).astype(np.int64)]
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), 1024):
        np.minimum(least, ring[places[at : at + 1024]].min(axis=0), out=least)
    key = np.arange(1, params.bands + 1, dtype=np.uint64)
    for column in least.reshape(params.bands, params.rows).T.astype(np.uint64):
        key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    bits = np.zeros(-(-n // 64) * 64, np.uint8)
    bits[:n] = least & 1
    return key.view(np.int64), np.packbits(bits).view(np.int64)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = words.split(column, words.NOT_SPACE, lower=True)
    every = words.windows(split.hashes, size)
    for k in range(len(column)):
        own = split.of(k)
        n = own.stop - own.start
        if not n:
            yield np.zeros(0, np.uint64)
        elif n < size:
            yield words.windows(split.hashes[own], n)
        else:
            yield np.unique(every[own.start : own.stop - size + 1])


def signatures(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, t, n, key, bands, bits) of docs (doc_id, text): hash of the text, set size, digest of the set, band hashes
    and one-bit signature (both null if the set is too small to be linked with another)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            sizes, keys, rows = [], [], []
            nothing = (None, None)
            for s in shingle_sets(block.column("text"), params.shingle):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                rows.append(bands(s, params) if len(s) >= params.smallest else nothing)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": block.column("doc_id"),
                    "t": block.column("t"),
                    "n": pa.array(sizes, pa.int64()),
                    "key": pa.array(keys, pa.binary()),
                    "bands": pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                    "bits": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(each, "doc_id long, t long, n long, key binary, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, shingles) of docs (doc_id, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            sets = [s.view(np.int64) for s in shingle_sets(block.column("text"), params.shingle)]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "shingles": pa.array(sets, pa.list_(pa.int64()))})

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id long, shingles array<long>")


def _may_link(a: str, b: str, params: Params) -> Column:
    """Whether sizes and one-bit signatures of two classes, as structs (rep, n, bits), allow a link."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    words_of_bits = -(-params.bands * params.rows // 64)
    differ = sum((F.bit_count(F.get(f"{a}.bits", i).bitwiseXOR(F.get(f"{b}.bits", i))) for i in range(words_of_bits)), F.lit(0))
    return (n * 100 >= m * params.least) & (m * 100 >= n * params.least) & (differ <= params.most_bits)


def _fetched(ids: DataFrame, texts: DataFrame, params: Params, owners: DataFrame | None) -> DataFrame:
    """The full sets of the texts with these doc_ids. Up to ``BROADCAST_IDS`` ids go to the texts, so those are not shuffled; beyond, both are.

    With owners (doc_id, of, t), the ids are numbers of classes: each stands for the text of hash t at the doc_id ``of``."""
    ids = stored(ids if owners is None else ids.join(owners, "doc_id"), "ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    on: str | list[str] = "doc_id"
    if owners is not None:
        texts, on = texts.select(F.col("doc_id").alias("of"), F.xxhash64("text").alias("t"), "text"), ["of", "t"]
    return stored(full_sets(texts.join(F.broadcast(ids) if few else ids, on), params), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose full sets are similar enough."""
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(common * 100 >= (F.size("x") + F.size("y") - common) * params.least).select("a", "b")


def _across(met: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """Distinct pairs (a, b) that may be linked, of classes that have the same ruler and are in different components.

    met: (lead, lead_component, rep, component), sets: (doc_id, shingles) of all of them."""
    rulers = sets.select(F.col("doc_id").alias("lead"), F.col("shingles").alias("c"))
    both = met.join(sets.withColumnRenamed("doc_id", "rep"), "rep").join(rulers, "lead")
    measured = both.select(
        "lead", "rep", "component", (F.col("component") != F.col("lead_component")).alias("apart"), F.size("shingles").alias("n"),
        F.size(F.array_intersect("shingles", "c")).alias("c"), F.array_except("shingles", "c").alias("off"),
    )
    measured = stored(measured, "measured")
    off = measured.select("lead", "rep", "apart", F.explode("off").alias("s"))
    # a pair has a class apart, so only shingles that such a class shares with another count
    counts = off.groupBy("lead", "s").agg(F.count("*").alias("k"), F.bool_or("apart").alias("any")).filter("k > 1 and any").select("lead", "s", (F.col("k") > HOT).alias("hot"))
    held = stored(off.select("lead", "rep", "s").join(counts, ["lead", "s"]), "shared")
    in_h = held.filter("hot").groupBy("lead", "rep").agg(F.count("*").cast("int").alias("h"))
    rows = measured.drop("off").join(in_h, ["lead", "rep"], "left").withColumn("h", F.coalesce("h", F.lit(0)))
    rows = stored(rows, "rulers")
    t = params.least

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}_{name}" for c in ("rep", "component", "apart", "n", "c", "h")})

    # two classes of the leader's component are linked already, so one of a pair lies apart; if both do, each pair counts once
    other = (F.col("component_x") != F.col("component_y")) & (~F.col("apart_y") | (F.col("rep_x") < F.col("rep_y")))
    reaches = lambda common: common * (100 + t) >= (F.col("n_x") + F.col("n_y")) * t
    bound = F.least("c_x", "c_y") + F.least("h_x", "h_y")
    # reaching by the bound means n_y <= on * 100 / t - (n_x - on), where on is what x has of the ruler
    on = F.col("c_x") + F.col("h_x")
    low, high = F.ceil(F.col("n_x") * t / 100).cast("int"), F.floor(on * 100 / t - (F.col("n_x") - on) + 1e-6).cast("int")
    # sizes fall into steps of one ratio, of which the sizes that may be linked with a class span 2 * STEPS and the ends
    grain = STEPS / math.log(100 / min(t, 99))
    step = lambda n: F.floor(F.log(n.cast("double")) * grain)
    sizes = side("x", rows).filter("apart_x").withColumns({"low": low, "high": high}).filter("high >= low")
    sizes = sizes.withColumn("step", F.explode(F.sequence(step(F.col("low")), step(F.col("high")))))
    near = sizes.join(side("y", rows).withColumn("step", step(F.col("n_y"))), ["lead", "step"]).filter(F.col("n_y").between(F.col("low"), F.col("high")) & other & reaches(bound)).select("rep_x", "rep_y")
    rare = held.filter("not hot").select("lead", "rep", "s").join(rows, ["lead", "rep"])
    outside = side("x", rare).filter("apart_x").join(side("y", rare), ["lead", "s"]).filter(other)
    shared = outside.groupBy("lead", "rep_x", "rep_y").agg(F.count("*").alias("k"), *[F.first(c).alias(c) for c in ("n_x", "n_y", "c_x", "c_y", "h_x", "h_y")])
    more = shared.filter(reaches(bound + F.col("k"))).select("rep_x", "rep_y")
    return near.unionByName(more).select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def _judged(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, t, n, node, component) of each row of docs (doc_id, text): ``node`` tells components apart and is null for
    the empty set, ``component`` is the smallest doc_id of it.

    A class goes by its smallest doc_id. If a doc_id has several sets, by a number in the order of doc_id and digest."""
    signed = stored(signatures(docs, params), "signatures")
    alive = signed.filter("key is not null and doc_id is not null")
    classes = stored(
        alive.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes"
    )
    texts, owners = docs.select("doc_id", "text"), None
    if alive.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a != b").isEmpty():
        classes = classes.withColumn("rep", F.col("id"))
    else:
        numbers = stored(classes.select("id", "key").orderBy("id", "key").withColumn("rep", F.monotonically_increasing_id()), "numbers")
        classes = stored(classes.join(numbers, ["id", "key"]), "classes")
        owned = alive.select("key", F.col("doc_id").alias("id"), "t").join(classes.select("key", "id", "rep"), ["key", "id"])
        owners = stored(owned.groupBy(F.col("rep").alias("doc_id")).agg(F.first("id").alias("of"), F.min("t").alias("t")), "owners")
    rows = classes.filter("bands is not null").select("rep", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(rows.join(shared, "band"), "buckets")  # classes that share a bucket with another
    rank = members.groupBy("rep").agg(F.sum("size").alias("rank"))
    ranked = members.select("band", "rep").join(rank.join(classes.select("rep", "n", "bits"), "rep"), "rep")
    lead = ranked.groupBy("band").agg(F.max(F.struct("rank", (-F.col("rep")).alias("order"), "rep", "n", "bits")).alias("y"))
    stars = stored(ranked.select("band", F.struct("rep", "n", "bits").alias("x")).join(lead, "band"), "stars")
    pairs = stars.filter((F.col("x.rep") != F.col("y.rep")) & _may_link("x", "y", params))
    pairs = stored(pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct(), "pairs")
    near = None
    known = stars.select("band", F.col("x.rep").alias("rep"), F.struct("y.rank", "y.order", "y.rep").alias("lead"))
    if not pairs.isEmpty():
        sets = _fetched(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), texts, params, owners)
        links = stored(confirmed(pairs, sets, params), "links")
        near = components(links)
        known = known.join(near.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        known = known.withColumn("component", F.col("rep"))
    still = known.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("band")
    highest = known.groupBy("rep").agg(F.max("lead").alias("best"))
    open_ = stored(known.join(still, "band").join(highest, "rep").select("band", "rep", "component", "best"), "open")
    rulers = open_.groupBy("band").agg(F.max("best").getField("rep").alias("lead"))
    met = open_.join(rulers, "band").select("lead", "rep", "component").distinct()
    if near is not None:
        met = met.join(near.select(F.col("node").alias("lead"), F.col("component").alias("lead_component")), "lead", "left").withColumn("lead_component", F.coalesce("lead_component", "lead"))
    else:
        met = met.withColumn("lead_component", F.col("lead"))
    met = stored(met, "met")
    if not met.isEmpty():
        sets = _fetched(met.select(F.explode(F.array("rep", "lead")).alias("doc_id")).distinct(), texts, params, owners)
        more = stored(_across(met, sets, params).join(pairs, ["a", "b"], "left_anti"), "across")
        if not more.isEmpty():
            found = stored(confirmed(more, sets, params), "links")
            near = components(found if near is None else found.unionByName(near.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    found = classes.select("key", "rep", F.col("rep").alias("component"))
    if near is not None:
        found = found.drop("component").join(near.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = classes.select(F.col("rep").alias("component"), F.col("id").alias("least"))
    found = found.join(named, "component") if owners is not None else found.withColumn("least", F.col("component"))
    found = found.select("key", F.col("component").alias("node"), "least")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component")
    return signed.select("doc_id", "t", "n", "key").join(found, "key", "left").select("doc_id", "t", "n", "node", component)


def linked(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, n, component) of each row of docs (doc_id, text)."""
    return _judged(docs, params).select("doc_id", "n", "component")


def kept(docs: DataFrame, params: Params = Params()) -> DataFrame:  # noqa: B008
    """Those rows of ``docs`` that stay when one document of each component does, the one of the smallest doc_id. Only
    the doc_ids that go are joined with the texts, with a hash of the text, as others may share the doc_id."""
    judged = stored(_judged(docs, params).filter("doc_id is not null").drop("n"), "judged")
    ends = judged.filter("component = doc_id")
    several = ends.filter("node is not null").groupBy("node").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter("a != b")
    also = ends.join(several, "node").filter("t != a")  # other texts of the component with the same doc_id
    gone = stored(judged.filter("component < doc_id").select("doc_id", "t").unionByName(also.select("doc_id", "t")).distinct(), "gone")
    repeated = stored(ends.groupBy("doc_id", "t").agg(F.count("*").alias("k")).filter("k > 1").drop("k"), "repeated")
    (t,) = fresh(docs, "t")

    def some(ids: DataFrame) -> DataFrame:
        """Ids as a side of a join with the texts, which stay where they are while the ids are ``BROADCAST_IDS`` at most."""
        named = ids.withColumnRenamed("t", t)
        return F.broadcast(named) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else named

    rows = docs.withColumn(t, F.xxhash64("text")).join(some(gone), ["doc_id", t], "left_anti")
    if not repeated.isEmpty():
        twice = some(repeated)
        one = rows.join(twice, ["doc_id", t], "left_semi").dropDuplicates(["doc_id", t])
        rows = rows.join(twice, ["doc_id", t], "left_anti").unionByName(one)
    return rows.select(*own(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = linked(docs, Params(shingle=3, least=85))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))
