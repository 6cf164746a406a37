"""The column functions under names that SQL can call."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _pieces(call: str) -> list[str]:
    """The arguments of a printed call, split at its own commas; quoted text is passed over."""
    out, depth, quote, start, i = [], 0, "", 0, 0
    while i < len(call):
        c = call[i]
        if quote:
            if c == "\\":
                i += 1
            elif c == quote:
                quote = ""
        elif c in "'`\"":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and not depth:
            out.append(call[start:i].strip())
            start = i + 1
        i += 1
    return [*out, call[start:].strip()]


def _closing(text: str, at: int) -> int:
    """Where the bracket that is open before ``at`` closes."""
    depth, quote = 1, ""
    while depth:
        c = text[at]
        if quote:
            if c == "\\":
                at += 1
            elif c == quote:
                quote = ""
        elif c in "'`\"":
            quote = c
        else:
            depth += (c in "([") - (c in ")]")
        at += 1
    return at - 1


def sql_of(column: Column) -> str:
    """The column as SQL; lambdas, which Spark prints as calls, are written as arrows."""
    spark = SparkSession.active()
    text, mark = spark._jsparkSession.expression(column._jc).sql(), "lambdafunction("
    while (at := text.rfind(mark)) >= 0:
        end = _closing(text, at + len(mark))
        body, *names = _pieces(text[at + len(mark) : end])
        told = names[0] if len(names) == 1 else f"({', '.join(names)})"
        text = f"{text[:at]}({told} -> {body}){text[end + 1 :]}"
    # Operators print as calls of their names, which only quotes make callable.
    return re.sub(r"(?<![\w`])(and|or|not)\(", r"`\1`(", f"({text})")


def register(spark: SparkSession) -> None:
    """Temporary functions ``highlight_passage`` and ``thml_walk``, and table functions of one text, ``extract_citations`` and ``thml_hits``."""
    from ..operators.citations import FOUND, found_in
    from ..operators.highlight import highlight_passage
    from ..sources.thml import HIT, hits_function, walk_function

    marked = sql_of(highlight_passage(F.col("passage"), F.col("chapter"), F.col("verse_key")))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION highlight_passage(passage STRING, chapter INT, verse_key STRING) RETURNS STRING RETURN {marked}")
    found = sql_of(found_in(F.col("body")))
    kinds = dict(book="STRING", book_slug="STRING")
    columns = ", ".join(f"{c} {kinds.get(c, 'INT')}" for c in FOUND)
    fields = ", ".join(f"m.{c}" for c in FOUND)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION extract_citations(body STRING) RETURNS TABLE({columns}) RETURN SELECT {fields} FROM (SELECT explode({found}) AS m)")
    spark.udf.register("thml_walk", walk_function())
    spark.udf.register("thml_hit_list", hits_function())
    # A table by explode: a table function in Python would be called, and hand its rows over, for each document.
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION thml_hits(content STRING) RETURNS TABLE({HIT}) RETURN SELECT h.* FROM (SELECT explode(thml_hit_list(content)) AS h)")
