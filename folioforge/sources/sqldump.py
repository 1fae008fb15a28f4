"""INSERT ... VALUES dumps to rows."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "array<struct<stmt:int,`row`:int,tab:string,cols:array<string>,vals:array<string>>>"
_HEAD = re.compile(r"\s*INSERT\s+INTO\s+([^\s(]+)\s*(?:\(([^)]*)\))?\s*VALUES\s*", re.I)
_NAME = str.maketrans("", "", "[]`\"")


def _tokens(text: str, at: int):
    """Values of one parenthesised tuple, as (values, position after it)."""
    vals, buf, depth, n = [], [], 0, len(text)
    quoted = False
    while at < n:
        c = text[at]
        if c == "'":
            end = at + 1
            while end < n:
                if text[end] == "'" and text[end : end + 2] == "''":
                    end += 2
                elif text[end] == "'":
                    break
                else:
                    end += 1
            buf.append(text[at : end + 1])
            at, quoted = end + 1, True
            continue
        if c == "(":
            depth += 1
        if c == ")" and depth:
            depth -= 1
        elif c in ",)" and not depth:
            vals.append(literal("".join(buf).strip()))
            buf, quoted = [], False
            if c == ")":
                return vals, at + 1
            at += 1
            continue
        buf.append(c)
        at += 1
    return None, n


def literal(raw: str) -> str | None:
    """NULL is null; quoted text loses its quotes (N'...' too); all else stays as written."""
    if raw.upper() == "NULL":
        return None
    m = re.fullmatch(r"[Nn]?'(.*)'", raw, re.S)
    return m[1].replace("''", "'") if m else raw


def parse_inserts(text: str | None) -> list[dict]:
    """Rows of all INSERT statements; other statements are skipped."""
    out, at, stmt, text = [], 0, 0, text or ""
    while m := re.compile(r"\bINSERT\s+INTO\b", re.I).search(text, at):
        head = _HEAD.match(text, m.start())
        if not head:
            at = m.end()
            continue
        name = head[1].translate(_NAME).split(".")[-1]
        cols = [c.strip().translate(_NAME) for c in head[2].split(",")] if head[2] else []
        at, row = head.end(), 0
        while at < len(text) and text[at] == "(":
            vals, at = _tokens(text, at + 1)
            if vals is None:
                break
            out.append({"stmt": stmt, "row": row, "tab": name, "cols": cols or [f"col{i}" for i in range(len(vals))], "vals": vals})
            row += 1
            more = re.compile(r"\s*,\s*(?=\()").match(text, at)
            if not more:
                break
            at = more.end()
        stmt += 1
    return out


def insert_rows(dumps: DataFrame, column: str = "value") -> DataFrame:
    """stmt, row, tab, cols, vals of each row of each dump (one dump per input row)."""

    @F.pandas_udf(ROWS)
    def parse(s: pd.Series) -> pd.Series:
        return s.map(parse_inserts)

    return dumps.select(F.explode(parse(F.col(column))).alias("r")).select("r.*")


def as_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """One string column per name, by position, as the first table's columns."""
    return rows.select(*[F.try_element_at("vals", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
