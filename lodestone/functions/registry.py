"""Scalars and table functions under SQL names.

Scalars become SQL functions whose body is the same expression that the DataFrame API
uses, so Catalyst inlines them and no row goes through Python.  Table functions are
Python ones.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from . import classify as K
from . import text as T
from . import urls as U

_INFIX = {"=": "=", "==": "=", "<=>": "<=>", "<": "<", "<=": "<=", ">": ">", ">=": ">=", "+": "+", "-": "-", "*": "*", "/": "/", "%": "%", "and": "AND", "or": "OR", "rlike": "RLIKE"}


def _list(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def sql_text(column: Column) -> str:
    """SQL of a column made of names, literals, functions, CASE, casts and lambdas."""
    return _render(column._jc.node())


def _render(node) -> str:
    kind = node.getClass().getSimpleName()
    if kind == "UnresolvedAttribute":
        return "`" + "`.`".join(_list(node.nameParts())) + "`"
    if kind == "UnresolvedNamedLambdaVariable":
        return node.name()
    if kind == "Literal":
        value = node.value()
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "NULL" if value is None else node.sql()
    if kind == "Alias":
        return _render(node.child())
    if kind == "Cast":
        return f"CAST({_render(node.child())} AS {node.dataType().sql()})"
    if kind == "LambdaFunction":
        names = [_render(a) for a in _list(node.arguments())]
        return f"({', '.join(names)}) -> {_render(node.function())}" if len(names) > 1 else f"{names[0]} -> {_render(node.function())}"
    if kind == "CaseWhenOtherwise":
        branches = " ".join(f"WHEN {_render(b._1())} THEN {_render(b._2())}" for b in _list(node.branches()))
        last = node.otherwise()
        return f"(CASE {branches}{' ELSE ' + _render(last.get()) if last.isDefined() else ''} END)"
    if kind == "UnresolvedFunction":
        name, args = node.functionName(), [_render(a) for a in _list(node.arguments())]
        if name in _INFIX and len(args) == 2:
            return f"({args[0]} {_INFIX[name]} {args[1]})"
        if name in ("!", "not"):
            return f"(NOT {args[0]})"
        if name == "in":
            return f"({args[0]} IN ({', '.join(args[1:])}))"
        if name in ("isnull", "isnotnull", "negative"):
            return {"isnull": f"({args[0]} IS NULL)", "isnotnull": f"({args[0]} IS NOT NULL)", "negative": f"(-{args[0]})"}[name]
        return f"{name}({', '.join(args)})"
    raise ValueError(f"no SQL for {kind}")


def _scalars() -> dict[str, tuple[str, str, Column]]:
    c = F.col
    none = F.lit(None).cast("string")
    return {
        "canon_url": ("url STRING", "STRING", U.canon_url(c("url"))),
        "url_key": ("url STRING", "STRING", U.url_key(U.canon_url(c("url")))),
        "resolve_url": ("base STRING, href STRING", "STRING", U.resolve(c("base"), c("href"))),
        "in_scope": ("url STRING", "BOOLEAN", U.in_scope(c("url"))),
        "page_type": ("url STRING, title STRING", "STRING", K.page_type(c("url"), c("title"))),
        "segment": ("url STRING, title STRING", "STRING", K.segment(c("url"), c("title"))),
        "lang_of": ("url STRING, text STRING", "STRING", T.detect_language(c("url"), none, c("text"), none)),
        "tokenize": ("text STRING", "ARRAY<STRING>", T.tokenize(c("text"))),
        "word_count": ("text STRING", "BIGINT", T.word_count(c("text"))),
        "snippet": ("text STRING", "STRING", T.snippet(c("text"))),
    }


@udtf(returnType="chunk_index: int, text: string")
class ChunkText:
    """Chunks of a text, in order."""

    def eval(self, text: str, target: int, overlap: int):
        from lodestone.operators.corpus import chunk_text

        yield from enumerate(chunk_text(text, target, overlap))


@udtf(returnType="title: string, text: string, word_count: int, n_sections: int, hrefs: array<string>")
class ParseHtml:
    """One row for a page."""

    def eval(self, page: str, url: str):
        from lodestone.operators.html import parse_page

        d = parse_page(page or "", url or "")
        yield d["title"], d["text"], d["word_count"], len(d["sections"]), d["hrefs"]


def register(spark: SparkSession) -> list[str]:
    """Make all functions known to ``spark.sql``; returns their names."""
    found = _scalars()
    for name, (parameters, returns, body) in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {sql_text(body)}")
    spark.udtf.register("chunk_text", ChunkText)
    spark.udtf.register("parse_html", ParseHtml)
    return [*found, "chunk_text", "parse_html"]
