"""Scalar functions of the question-answering domain, as column expressions that Catalyst can see through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_WIDTH, ASCII_DIGITS = "０１２３４５６７８９", "0123456789"
#: White space as Unicode has it, with the four information separators.
SPACE = r"(?U)[\s\x1c-\x1f]"

# Numbers, heading patterns, roman numerals, footnote marks, the answer mark and the ids of the domain's documents.
NUMBER = r"-?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"
TOP_HEADING = r"^\s*[IVX]{1,5}\s*[.．]\s*.{1,40}$"
SUB_HEADING = r"^\s*[0-9]{1,2}\s*[.．]\s*.{1,40}$"
ROMAN = {
    "Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X",
    "ⅰ": "I", "ⅱ": "II", "ⅲ": "III", "ⅳ": "IV", "ⅴ": "V",
}
FOOTNOTE = r"\(주\s*[0-9]\)|주[0-9]\)|\*[^*]"
ANSWER = r"(?md)최종답\s*[:：]\s*(.+?)\s*$"
ITEM_ID, CHUNK_ID = "DART_%s_%03d", "%s_%d_%s_%03d"
# End of the fixed values.

#: Where a text is cut into lines.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def zfill(value: Column, width: int) -> Column:
    """Pad with zeros on the left; longer values stay whole."""
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)


def parse_number(text: Column) -> Column:
    """The first number of a text as a double, thousands commas allowed; null without one."""
    bare = F.replace(F.translate(text, FULL_WIDTH, ASCII_DIGITS), F.lit(" "), F.lit(""))
    return F.replace(F.regexp_extract(bare, NUMBER, 0), F.lit(","), F.lit("")).try_cast("double")


def normalize_text(text: Column) -> Column:
    """Lower case without any white space."""
    return F.lower(F.regexp_replace(text, SPACE, ""))


def stripped(text: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def lines(text: Column) -> Column:
    """The lines of a text, at any sign that ends one; null has none."""
    return F.split(F.coalesce(text, F.lit("")), LINE_END)


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def grade(predicted: Column, gold: Column, tolerance: float = 0.01) -> Column:
    """Whether an answer is right: numbers within a relative tolerance (strictly within it of a gold of zero), else equal normalised texts."""
    p, g = parse_number(predicted), parse_number(gold)
    numeric = F.when(g == 0, F.abs(p) < F.lit(tolerance)).otherwise(F.abs(p - g) / F.abs(g) <= F.lit(tolerance))
    return (
        F.when(predicted.isNull() | (predicted == "") | gold.isNull(), F.lit(False))
        .when(p.isNotNull() & g.isNotNull(), numeric)
        .otherwise(normalize_text(predicted) == normalize_text(gold))
    )


def final_answer(text: Column) -> Column:
    """What follows the last answer mark, else the last line that is not blank."""
    marked = F.try_element_at(F.regexp_extract_all(text, F.lit(ANSWER), F.lit(1)), F.lit(-1))
    return F.coalesce(marked, last_line(text))


def last_line(text: Column) -> Column:
    found = F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, rf"^{SPACE[4:]}+|{SPACE[4:]}+$", "")), lambda x: x != "")
    return F.try_element_at(found, F.lit(-1))


def classify(n_correct: Column, n_attempts: Column) -> Column:
    """Difficulty by the share of right attempts; no attempts at all count as all right."""
    return F.when(n_correct == n_attempts, "too_easy").when(n_correct == 0, "too_hard").otherwise("accepted")


def usd(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Prices are for a million tokens."""
    return tokens_in / F.lit(1e6) * F.lit(price_in) + tokens_out / F.lit(1e6) * F.lit(price_out)


def normalize_heading(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign, letters in ROMAN.items():
        out = F.replace(out, F.lit(sign), F.lit(letters))
    return collapse(F.replace(out, F.lit("．"), F.lit(".")))


def heading_matches(text: Column, patterns: Column) -> Column:
    """Whether a heading contains one of the patterns, spaces aside."""
    bare = F.replace(normalize_heading(text), F.lit(" "), F.lit(""))
    return F.exists(patterns, lambda p: F.contains(bare, F.replace(p, F.lit(" "), F.lit(""))))


def heading_kind(text: Column) -> Column:
    """top, sub or null."""
    return F.when(text.rlike(TOP_HEADING), "top").when(text.rlike(SUB_HEADING), "sub")


def clean_cell(cell: Column) -> Column:
    """A table cell on one line without the mark that parts cells."""
    return collapse(F.translate(F.coalesce(cell, F.lit("")), "\n\r|", "  /"))


def is_table_line(line: Column) -> Column:
    return F.regexp_replace(line, rf"^{SPACE}+", "").startswith("|")


def has_footnote(text: Column) -> Column:
    return text.rlike(FOOTNOTE)


def sentences(text: Column) -> Column:
    """Split after a full stop, question or exclamation mark that white space follows."""
    whole = collapse(text)
    parts = F.filter(F.split(whole, r"(?<=[.!?。])\s+"), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(whole))


def tokens(text: Column) -> Column:
    """The default tokenizer: words parted by white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda x: x != "")


def difficulty_group(hops: Column) -> Column:
    return F.when(hops.isNull(), "unknown").when(hops <= 2, "1-2_step").when(hops == 3, "3_step").otherwise("4plus_step")


def report_year(report: Column) -> Column:
    """The leading four digits as a number, else 0."""
    return F.coalesce(F.when(report.rlike("^[0-9]{4}"), F.substring(report, 1, 4).try_cast("int")), F.lit(0))


def item_id(code: Column, slot: Column) -> Column:
    return F.format_string(ITEM_ID, code, slot)


def chunk_id(company: Column, year: Column, section: Column, position: Column) -> Column:
    return F.format_string(CHUNK_ID, company, year, section, position)


def percent(share: Column) -> Column:
    """In per cent with one digit, halves to the even one."""
    return F.format_string("%.1f%%", F.bround(share * 100, 1))


def need_map(spec: Column) -> Column:
    """"T1:1,T2:2" as a map of counts."""
    pairs = F.filter(F.split(spec, ","), lambda x: F.trim(x) != "")
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit(":"), F.lit(1))), F.trim(F.split_part(x, F.lit(":"), F.lit(2))).cast("int"))))


def percent_of(part: Column, whole: Column) -> Column:
    """A share in per cent with one digit; of nothing it is 0."""
    return percent(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)))


def quote_spans(text: Column, quotes: Column) -> Column:
    """(start, end) of every place where one of the quotes stands in a text, from the left and not overlapping within a quote;
    blank quotes stand nowhere. Ends are exclusive."""
    def of(quote: Column) -> Column:
        parts = F.split(text, F.regexp_replace(quote, r"([^\w\s])", r"\\$1"))
        before = lambda i: F.char_length(F.array_join(F.slice(parts, 1, i + 1), "")) + i * F.char_length(quote)
        spans = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda _, i: F.struct(before(i).alias("start"), (before(i) + F.char_length(quote)).alias("end")))
        return F.when((quote == "") | (F.size(parts) < 2), F.array().cast("array<struct<start:int,end:int>>")).otherwise(spans)

    return F.array_sort(F.array_distinct(F.flatten(F.transform(quotes, of))))


def changed_fields(old: dict[str, Column], new: dict[str, Column]) -> Column:
    """Names of the fields that differ, in order; a missing field is null."""
    names = sorted(old.keys() | new.keys())
    return F.array_compact(F.array(*[F.when(~old.get(n, F.lit(None)).eqNullSafe(new.get(n, F.lit(None))), F.lit(n)) for n in names]))
