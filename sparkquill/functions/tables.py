"""Markdown tables and evidence blocks, as column expressions over one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S

#: Fixed value: a cell of the row that parts a table's head from its body.
SEPARATOR = r"^:?-{2,}:?$"


def parse_markdown_table(text: Column) -> Column:
    """The rows of the lines that begin with a pipe, padded to one width; separator rows are left out."""
    lines = F.filter(F.transform(S.lines(text), S.stripped), lambda x: x.startswith("|"))
    # one pipe at either end frames the row, any more are empty cells
    inner = F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, r"^\|", ""), r"\|$", ""))
    rows = F.transform(inner, lambda x: F.transform(F.split(x, r"\|"), S.stripped))

    def separator(row: Column) -> Column:
        # a row that has a filled cell, and none but of dashes
        return F.exists(row, lambda c: c != "") & F.forall(row, lambda c: (c == "") | F.replace(c, F.lit(" "), F.lit("")).rlike(SEPARATOR))

    body = F.filter(rows, lambda r: ~separator(r))
    # text and width once, not for each row
    sized = let(body, lambda b: F.struct(b.alias("rows"), F.coalesce(F.array_max(F.transform(b, lambda r: F.size(r))), F.lit(0)).alias("width")))
    return let(sized, lambda t: F.transform(t["rows"], lambda r: F.concat(r, F.array_repeat(F.lit(""), t["width"] - F.size(r)))))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once for all uses that ``body`` makes of it within lambdas."""
    return F.transform(F.array(value), body)[0]


def blocks(text: Column) -> Column:
    """(kind, text) of each stretch of lines of one kind, table or text; blank lines end no block.

    A block is the slice of lines between two changes of kind, so each line is copied once."""
    lines = F.filter(S.lines(text), lambda x: S.stripped(x) != "")
    tagged = F.transform(lines, lambda x: F.struct(S.is_table_line(x).alias("table"), x.alias("text")))
    is_start = lambda held, x, i: (i == 0) | (F.get(held, i - 1)["table"] != x["table"])

    def cut(held: Column, starts: Column) -> Column:
        def block(start: Column, i: Column) -> Column:
            size = F.coalesce(F.get(starts, i + 1), F.size(held)) - start
            joined = F.array_join(F.transform(F.slice(held, start + 1, size), lambda x: x["text"]), "\n")
            kind = F.when(F.get(held, start)["table"], "table").otherwise("text")
            return F.struct(kind.alias("kind"), S.stripped(joined).alias("text"))

        return F.transform(starts, block)

    return F.when(text.isNotNull(), let(tagged, lambda held: let(F.array_compact(F.transform(held, lambda x, i: F.when(is_start(held, x, i), i))), lambda starts: cut(held, starts))))


def assemble(found: Column) -> Column:
    """pre_text, table and post_text of blocks: the first table parts the prose; further tables stay as lines behind it."""
    at = F.coalesce(F.array_position(F.transform(found, lambda b: b["kind"]), F.lit("table")), F.lit(0)).cast("int")
    lines = lambda b: F.when(b["kind"] == "table", F.split(b["text"], "\n")).otherwise(S.sentences(b["text"]))
    before = F.when(at == 0, found).otherwise(F.slice(found, 1, F.greatest(at - 1, F.lit(0))))
    after = F.when(at == 0, F.slice(found, 1, 0)).otherwise(F.slice(found, at + 1, F.size(found)))
    return F.struct(
        F.flatten(F.transform(before, lines)).alias("pre_text"),
        parse_markdown_table(F.when(at > 0, F.get(found, at - 1)["text"])).alias("table"),
        F.flatten(F.transform(after, lines)).alias("post_text"),
    )


def gold_inds(quotes: Column, table: Column, pre: Column, post: Column) -> Column:
    """Supporting facts by name: quotes with a pipe are table_i, others text_i; without quotes the first fact there is."""
    quotes = F.filter(F.transform(F.coalesce(quotes, F.array().cast("array<string>")), lambda q: F.trim(q)), lambda q: q != "")
    pick = lambda kind: F.filter(quotes, lambda q: q.contains("|") if kind == "table" else ~q.contains("|"))
    named = lambda kind: F.transform(pick(kind), lambda q, i: F.struct(F.concat(F.lit(f"{kind}_"), i.cast("string")).alias("k"), q.alias("v")))
    one = lambda k, v: F.map_from_entries(F.array(F.struct(F.lit(k).alias("k"), v.alias("v"))))
    return (
        F.when(F.size(quotes) > 0, F.map_from_entries(F.concat(named("table"), named("text"))))
        .when(F.size(table) > 1, one("table_0", F.concat_ws(" | ", F.get(table, 1))))
        .when(F.size(pre) > 0, one("text_0", F.get(pre, 0)))
        .when(F.size(post) > 0, one("text_0", F.get(post, 0)))
        .otherwise(F.map_from_entries(F.array().cast("array<struct<k:string,v:string>>")))
    )
