"""Selections and joins that pick rows by an explicit order column: DataFrames carry no order of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order. Spark limits groups before the shuffle (WindowGroupLimit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """As a dictionary filled row by row keeps the last of each key."""
    return first_by(df, keys, F.col(order).desc())


def subset(df: DataFrame, column: str, values: list) -> DataFrame:
    """All rows without values to choose from, else those with one of them."""
    return df.filter(F.col(column).isin(values)) if values else df


def fiscal_window(filings: DataFrame, years: DataFrame, date: str = "rcept_dt", year: str = "year") -> DataFrame:
    """Each filing with every year whose window it falls in: 1 January to 30 June of the next year, dates as yyyyMMdd text.

    A date lies in the windows of its own year and, up to June, of the year before: an equi-join on those two."""
    own = F.substring(date, 1, 4).cast("int")
    candidate = F.explode(F.array(own, own - 1))
    low, high = F.concat(F.col(year).cast("string"), F.lit("0101")), F.concat((F.col(year) + 1).cast("string"), F.lit("0630"))
    return filings.withColumn("_year", candidate).join(years, F.col("_year") == F.col(year)).filter(F.col(date).between(low, high)).drop("_year")


def with_keyword(df: DataFrame, column: str, keywords: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(k)) for k in keywords], F.lit(False)))


def latest(filings: DataFrame, keys: list[str], date: str, order: str) -> DataFrame:
    """The latest filing of each key; equal dates keep the input's order."""
    return first_by(filings, keys, F.col(date).desc(), F.col(order))


def preferred(df: DataFrame, keys: list[str], choice: str, preference: list[str], *order: Column) -> DataFrame:
    """For each key the row whose ``choice`` comes first in a list of preferences; values outside the list do not count."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col(choice))
    return first_by(df.withColumn("preference_rank", rank).filter("preference_rank > 0"), keys, F.col("preference_rank"), *order)


def cascade(outcomes: DataFrame, keys: list[str], preference: list[str], compat: bool = False) -> DataFrame:
    """What comes of trying report codes in order of preference: the fields of a manifest row (report_code, rcept_no,
    report_nm, file, status, reason) for each key.

    outcomes: (keys ..., report_code, list_error, rcept_no, report_nm, file, cached, dry_run, download_error), a row for each
    code tried. A list error goes on to the next code, as does a list without a fitting report (no rcept_no); the first
    report found ends it: cached, dry_run, downloaded, or error where its download fails. ``reason`` is the download's error,
    else the last list error on the way, else, with nothing found, that no report matched (with ``compat`` that one whatever
    the lists said). Codes outside the preference do not count; a key all of whose codes are outside is missing."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col("report_code"))
    tried = F.struct(rank.alias("rank"), "report_code", "list_error", "rcept_no", "report_nm", "file", "cached", "dry_run", "download_error")
    lists = outcomes.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(rank > 0, tried))).alias("_tried"))  # as many as there are codes
    found = lambda t: t["list_error"].isNull() & t["rcept_no"].isNotNull()
    ended = lists.withColumn("_end", F.get(F.filter("_tried", found), F.lit(0)))
    before = F.filter("_tried", lambda t: t["list_error"].isNotNull() & (F.col("_end").isNull() | (t["rank"] < F.col("_end.rank"))))
    ended = ended.withColumn("_listed", F.concat(F.lit("list_error:"), F.try_element_at(before, F.lit(-1))["list_error"]))
    end = lambda c: F.col(f"_end.{c}")
    held = F.coalesce(end("cached"), F.lit(False))
    dry = ~held & F.coalesce(end("dry_run"), F.lit(False))
    failed = ~held & ~dry & end("download_error").isNotNull()
    status = F.when(F.col("_end").isNull(), "missing").when(held, "cached").when(dry, "dry_run").when(failed, "error").otherwise("downloaded")
    nothing = F.lit("no_matching_report_in_year")
    reason = F.when(F.col("_end").isNull(), nothing if compat else F.coalesce("_listed", nothing)).when(failed, F.concat(F.lit("download_error:"), end("download_error"))).otherwise(F.col("_listed"))
    file = F.when(~dry & ~failed, end("file"))
    return ended.select(*keys, end("report_code").alias("report_code"), end("rcept_no").alias("rcept_no"), end("report_nm").alias("report_nm"), file.alias("file"), status.alias("status"), reason.alias("reason"))


def resolve_codes(companies: DataFrame, corp_map: DataFrame, width: int = 8) -> DataFrame:
    """Companies (name, stock, corp_code) with the code of the map (stock, resolved_code, ord) where it has one, padded, and whether the two differ."""
    first = first_by(corp_map, ["stock"], F.col("ord")).drop("ord")
    joined = companies.join(first, "stock", "left")
    configured = S.zfill(F.col("corp_code"), width)
    resolved = S.zfill(F.coalesce("resolved_code", "corp_code"), width)
    return joined.select("name", "stock", resolved.alias("corp_code"), F.coalesce(configured != resolved, F.lit(False)).alias("mismatch"))


def with_report_codes(sections: DataFrame, manifest: DataFrame, order: str) -> DataFrame:
    """sections (company, year, ...) with the report code of the manifest (company, year, report_code), of several rows the last in order."""
    codes = last_wins(manifest.filter("report_code is not null").select("company", "year", "report_code", order), ["company", "year"], order).drop(order)
    return sections.join(codes, ["company", "year"], "left")


def with_receipts(items: DataFrame, manifest: DataFrame, order: str, viewer: str = "%s") -> DataFrame:
    """items (source_company, source_report, ...) with ``rcept_no``, by company and the year that the report's name begins with,
    and ``link``: the number set into the viewer's address."""
    numbers = last_wins(manifest.filter("rcept_no is not null").select("company", "year", "rcept_no", order), ["company", "year"], order)
    numbers = numbers.select(F.col("company").alias("_c"), F.col("year").alias("_y"), "rcept_no")
    on = (F.col("source_company") == F.col("_c")) & (S.report_year(F.col("source_report")) == F.col("_y"))
    return items.join(numbers, on, "left").drop("_c", "_y").withColumn("link", F.format_string(viewer, "rcept_no"))


def wanted_reports(companies: DataFrame, years: DataFrame, codes: list[str]) -> DataFrame:
    """(name, corp_code, year, report_code, preference): what is to be fetched, the report codes of each company and year in order
    of preference. Companies and years are configuration, so the years go along as one array."""
    all_years = years.agg(F.array_sort(F.collect_set("year")).alias("_years"))
    each = companies.join(F.broadcast(all_years)).withColumn("year", F.explode("_years")).drop("_years")
    return each.select("name", "corp_code", "year", F.posexplode(F.array(*map(F.lit, codes))).alias("preference", "report_code"))


def next_slot(ids: DataFrame, column: str, prefix: str) -> DataFrame:
    """One more than the largest number behind a prefix, 1 without any."""
    number = F.when(F.col(column).startswith(prefix), F.substr(F.col(column), F.lit(len(prefix) + 1)).try_cast("long"))
    return ids.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_slot"))


def missing(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are still to be done."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")
