"""Table functions and functions for SQL: what needs a tree, an archive or a fold, by name."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkquill.operators import chunking, evidence, html_blocks, sections


@F.udtf(returnType="pos int, kind string, payload string")
class HtmlBlocks:
    """html_blocks(html): its text and table blocks in order."""

    def eval(self, html: str):
        for i, (kind, payload) in enumerate(html_blocks.blocks(html)):
            yield i, kind, payload


@F.udtf(returnType="pos int, text string, kinds array<string>, token_count int")
class HtmlChunks:
    """html_chunks(html, size, overlap): chunks of a token budget."""

    def eval(self, html: str, size: int, overlap: int):
        packer = chunking.Packer(size, overlap)
        for i, (text, kinds) in enumerate(packer.pack(html_blocks.blocks(html))):
            yield i, text, kinds, packer.count(text)


@F.udtf(returnType="name string, pos int, markup string")
class ZipMembers:
    """zip_members(content): the XML files of an archive."""

    def eval(self, content: bytes):
        for i, (name, text) in enumerate(sections.members(content) if content else ()):
            yield name, i, text


@F.udtf(returnType="strategy string, html string")
class SectionOf:
    """section_of(markup, parents, titles): the section under a top heading and a sub-heading, no row if there is none."""

    def eval(self, markup: str, parents: list, titles: list):
        root, spec = html_blocks.soup(markup), sections.Spec("", tuple(parents or ()), tuple(titles or ()))
        for strategy, find in (("structured", sections.structured), ("textual", sections.textual)):
            html = find(root, spec)
            if html is not None:
                yield strategy, html
                return


TABLE_FUNCTIONS = {"html_blocks": HtmlBlocks, "html_chunks": HtmlChunks, "zip_members": ZipMembers, "section_of": SectionOf}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    for name, function in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, function)
    spark.udf.register("outermost_json", evidence.outermost_json, "string")
