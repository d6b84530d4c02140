"""Files in and out: JSON records, review files of three shapes, archives, logs, section files."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill import schemas
from sparkquill.functions import scalars as S
from sparkquill.operators import html_blocks
from sparkquill.operators.relational import first_by
from sparkquill.sources import zips


ITEM = "struct<" + schemas.ITEM.replace(" string", ":string").replace(" array", ":array").replace(" int", ":int") + ">"
STATE = f"struct<item:{ITEM},status:string,discard_reason:string,regenerate_reason:string,reviewer_notes:string,last_touched:string>"


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record a line; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def calibration(spark: SparkSession, path: str) -> DataFrame:
    """Calibration results by item, of arrays in files; of several rows of one item the last in its file, and the last file, win."""
    item = "array<struct<" + schemas.CALIBRATION.replace(" string", ":string").replace(" array", ":array") + ">>"
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", item)).alias("_p", "r"), F.col("_metadata.file_path").alias("_f"))
    return first_by(raw.select("r.*", "_f", "_p"), ["item_id"], F.col("_f").desc(), F.col("_p").desc()).drop("_f", "_p")


def chunk_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Chunks by id; of several rows of one id the last file and line win."""
    rows = spark.read.schema(schemas.CHUNK).json(path).select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    return first_by(rows, ["chunk_id"], F.col("_f").desc(), F.col("_b").desc(), F.col("_i").desc()).drop("_f", "_b", "_i")


def reviewed(spark: SparkSession, path: str) -> DataFrame:
    """Items of review files: a bare array, an object with ``items``, or one with ``states``, of which accepted and edited ones count."""
    raw = spark.read.text(path, wholetext=True)
    bare = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{ITEM}>"))
    whole = F.from_json("value", f"items array<{ITEM}>, states array<struct<item:{ITEM},status:string>>")
    states = F.transform(F.filter(whole["states"], lambda s: s["status"].isin("accepted", "edited")), lambda s: s["item"])
    return raw.select(F.explode(F.coalesce(bare, whole["items"], states)).alias("i")).select("i.*")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(report, member, member_ord, markup) of the XML files in ZIP archives of any size; a task holds a member, not an archive."""
    found = zips.contents(zips.members(zips.listing(spark, path), ".xml"))
    return found.select(F.col("path").alias("report"), "member", "member_ord", F.make_valid_utf8(F.col("content").cast("string")).alias("markup"))


def corp_map(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ``list`` elements in zipped XML."""
    names = ["corp_code", "corp_name", "stock_code", "modify_date"]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                rows = [[(e.findtext(n) or "").strip() for n in names] for _, e in ElementTree.iterparse(io.BytesIO(content)) if e.tag == "list"]
                yield pd.DataFrame(rows, columns=names)

    return zips.contents(zips.members(zips.listing(spark, path))).select("content").mapInPandas(each, schemas.CORP_MAP)


def section_files(spark: SparkSession, path: str) -> DataFrame:
    """(company, year, section, html) of files named company_year_section.html; other names are left out."""
    rows = spark.read.option("pathGlobFilter", "*.html").text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    parts = F.split(F.regexp_replace(F.url_decode("name"), r"\.html$", ""), "_", 3)
    found = rows.select(F.get(parts, 0).alias("company"), F.get(parts, 1).try_cast("int").alias("year"), F.get(parts, 2).alias("section"), F.col("value").alias("html"))
    return found.filter("year is not null and section is not null")


def prior_states(spark: SparkSession, path: str) -> DataFrame:
    """(item, status, ...) of a review file with ``states``, or of a bare array of them; none of a file that is absent or no JSON, to start afresh."""
    states = f"array<{STATE}>"
    if not _fs(spark, path)[1]:
        return spark.createDataFrame([], STATE.removeprefix("struct<").removesuffix(">"))
    raw = spark.read.text(path, wholetext=True)
    bare = F.when(F.ltrim("value").startswith("["), F.from_json("value", states))
    return raw.select(F.explode(F.coalesce(bare, F.from_json("value", f"states {states}")["states"])).alias("s")).select("s.*")


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and whether there is something at it."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return fs, fs.exists(jvm_path)


def write_json_array(rows: DataFrame, path: str, most: int | None = None, order: list[str] | None = None) -> None:
    """One JSON array in one file, written row after row by one task, in an order if there is one. A caller that expects a
    curated set may refuse more than ``most`` rows."""
    if most is not None and rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: write JSON lines")
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    place = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    _replace(_one_text(rows.select(F.lit(0).alias("part"), place.alias("place"), record.alias("value")), ["["], "]"), path)


def save_reviewed(states: DataFrame, path: str, saved_at: str, most: int | None = None) -> None:
    """A review file: the states (item, status, ...) and the items that are accepted or edited, in the order of ``ord``.

    It is written beside and then moved into place, so that a reader finds the old file or the new one."""
    if most is not None and states.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} states")
    written = {"ignoreNullFields": "false"}
    fields = [c for c in states.columns if c != "ord"]
    whole = states.select(F.lit(0).alias("part"), F.col("ord").alias("place"), F.to_json(F.struct(*fields), written).alias("value"))
    items = states.filter(F.col("status").isin("accepted", "edited")).select(F.lit(1).alias("part"), F.col("ord").alias("place"), F.to_json("item", written).alias("value"))
    heads = [f'{{"saved_at":{json.dumps(saved_at)},"states":[', '],"items":[']
    _replace(_one_text(whole.unionByName(items), heads, "]}"), path)


def _one_text(records: DataFrame, heads: list[str], tail: str) -> DataFrame:
    """(value) in one partition: each head and its records (part, place, value) behind it, then the tail. Rows pass one by one,
    sorted on disk where they are many."""
    first = records.sparkSession.range(1).select(F.lit(-1).alias("part"), F.lit(None).cast(records.schema["place"].dataType).alias("place"), F.lit("").alias("value"))

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, begun = -1, False
        for frame in frames:
            out = []
            for part, value in zip(frame["part"].tolist(), frame["value"], strict=True):
                while at < part:
                    at, begun = at + 1, False
                    out.append(heads[at])
                if part >= 0:
                    out.append(f",{value}" if begun else value)
                    begun = True
            yield pd.DataFrame({"value": out}, dtype=object)
        yield pd.DataFrame({"value": [*heads[at + 1 :], tail]})

    return first.unionByName(records).repartition(1).sortWithinPartitions("part", "place").select("part", "value").mapInPandas(each, "value string")


def _replace(text: DataFrame, path: str) -> None:
    """Write the only row of ``text`` (value) as the file ``path``: to a folder beside it first, then by a rename over it."""
    spark = text.sparkSession
    new = f"{path}.new-{uuid.uuid4().hex}"
    text.coalesce(1).write.text(new)
    fs, _ = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001
    part = next(s.getPath() for s in fs.listStatus(hadoop.Path(new)) if s.getPath().getName().startswith("part-"))
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)  # noqa: SLF001
    over[0] = hadoop.Options.Rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    files.rename(part, files.makeQualified(hadoop.Path(path)), over)
    fs.delete(hadoop.Path(new), True)


def write_manifest(manifest: DataFrame, path: str) -> None:
    write_json_array(manifest, path)


def write_sections(found: DataFrame, path: str) -> None:
    """found (company, year, section, html): the markup and its text, a folder of either for each company, year and section."""
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=[html_blocks.plain(h) for h in frame["html"]])

    keys = ["company", "year", "section"]
    ready = found.filter("html is not null").select(*keys, "html").mapInPandas(each, "company string, year int, section string, html string, text string")
    both = ready.select(*keys, F.explode(F.array(F.struct(F.lit("html").alias("kind"), F.col("html").alias("value")), F.struct(F.lit("txt").alias("kind"), F.col("text").alias("value")))).alias("f"))
    both.select("f.kind", *keys, "f.value").write.mode("overwrite").partitionBy("kind", *keys).text(path)


def config(spark: SparkSession, path: str) -> dict:
    """A YAML file as it is parsed; one that is absent is an error."""
    import yaml

    if not _fs(spark, path)[1]:
        raise FileNotFoundError(path)
    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]) or {}


def config_tables(spark: SparkSession, config: dict) -> tuple[DataFrame, DataFrame]:
    """(companies, sections) of a parsed configuration: companies with padded codes, and what to look for in reports."""
    known = [(c.get("name"), c.get("corp_code"), c.get("stock"), c.get("sector")) for c in config.get("companies", [])]
    rows = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in known], schemas.COMPANY)
    specs = [(s["id"], list(s["parent_patterns"]), list(s["title_patterns"])) for s in config.get("sections", [])]
    return companies(rows), spark.createDataFrame(specs, "id string, parents array<string>, titles array<string>")


def setting(environ: dict[str, str], name: str) -> str:
    """A setting that must be there."""
    if not environ.get(name):
        raise KeyError(f"{name} is not set")
    return environ[name]


def manifest_pool(manifest: DataFrame) -> DataFrame:
    """Reports that were fetched, with a label of year and code."""
    code = F.substring(F.coalesce("report_code", F.lit("?")), 1, 5)
    return manifest.filter(F.col("status").isin("downloaded", "cached")).withColumn("label", F.concat_ws("_", F.col("year").cast("string"), code))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One folder for each company and year."""
    chunks.repartition("company", "year").write.mode("overwrite").partitionBy("company", "year").json(path)


def write_items(items: DataFrame, path: str) -> None:
    """JSON lines and Parquet beside each other."""
    items.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/jsonl")
    items.write.mode("overwrite").parquet(f"{path}/parquet")


def append_log(actions: DataFrame, path: str) -> None:
    """actions (ts, id, action, note) as text lines."""
    actions.select(F.concat_ws(" | ", "ts", "id", "action", F.coalesce("note", F.lit(""))).alias("value")).write.mode("append").text(path)


def companies(df: DataFrame) -> DataFrame:
    """The company table with padded codes."""
    return df.withColumns({"corp_code": S.zfill(F.col("corp_code"), 8), "stock": S.zfill(F.col("stock"), 6)})
