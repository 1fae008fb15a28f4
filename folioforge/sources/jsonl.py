"""JSON lines of nested blocks of any depth: good rows, rejects, and flat nodes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): blank lines are skipped, lines that don't parse are kept apart."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).filter(F.trim("value") != "")
    parsed = lines.withColumn("record", F.try_parse_json("value"))
    return parsed.filter("record is not null"), parsed.filter("record is null").select("file", "value")


def parsed_files(names: DataFrame, column: str, since: str | None = None) -> DataFrame:
    """Names parsed_<N or R>_<yyyymmdd>...jsonl not older than since; a date that doesn't parse passes."""
    if since is None:
        return names
    day = F.try_to_date(F.split_part(F.col(column), F.lit("_"), F.lit(3)), "yyyyMMdd")
    return names.filter(F.coalesce(day >= F.lit(since).cast("date"), F.lit(True)))


NODE = "path string, parent string, depth int, pos int, type string, content array<string>, anchor string, html string, text string, has_children boolean"
_FIELDS = tuple(f.split()[0] for f in NODE.split(", "))
#: About how many bytes of text, and how many rows, leave a Python worker at once.
MOST_BYTES, MOST_ROWS = 1 << 22, 4096


def _texts(value) -> list[str]:
    if value is None:
        return []
    return [str(x) for x in value] if isinstance(value, list) else [str(value)]


def flatten_record(line: str | None) -> list[dict]:
    """Nodes of a record in document order; a path's prefixes are its ancestors."""
    try:
        record = json.loads(line or "")
    except ValueError:
        return []
    out: list[dict] = []
    todo = [(b, f"{i:06d}", "", 0, i) for i, b in reversed(list(enumerate(record.get("content") or [])))] if isinstance(record, dict) else []
    while todo:
        block, path, parent, depth, pos = todo.pop()
        if not isinstance(block, dict):
            continue
        kids = block.get("children") or []
        out.append({"path": path, "parent": parent, "depth": depth, "pos": pos, "type": block.get("type"), "content": _texts(block.get("content")), "anchor": block.get("anchor"), "html": block.get("html"), "text": block.get("text"), "has_children": bool(kids)})
        todo += [(b, f"{path}.{i:06d}", path, depth + 1, i) for i, b in reversed(list(enumerate(kids)))]
    return out


def batches(rows: Iterable[tuple], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)
    for row in rows:
        out.append(row)
        held += _size(row)
        if held > MOST_BYTES or len(out) == MOST_ROWS:
            yield pack()
            out, held = [], 0
    if out:
        yield pack()


def rows_of(df: DataFrame, run: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """The rows that run() gives for each row of df, in small batches: a worker holds one of df's
    batches as Arrow has it, one row of it as Python objects, and a few MB of what it gives."""
    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches((row for part in parts for i in range(part.num_rows) for row in run(*(c[i].as_py() for c in part.columns))), kinds)

    return df.mapInArrow(each, schema)


def _size(value) -> int:
    if isinstance(value, str):
        return len(value)
    if isinstance(value, dict):
        return 8 + sum(_size(x) for x in value.values())
    return 8 + sum(_size(x) for x in value) if isinstance(value, (list, tuple)) else 8


def records(lines: DataFrame, value: str = "value") -> DataFrame:
    """cis, filename and line: what takes flat nodes takes these too, and walks each record once, where it lies."""
    source = F.try_parse_json(F.col(value))
    get = lambda p: F.try_variant_get(source, f"$.source.{p}", "string")
    return lines.select(get("cis").alias("cis"), get("filename").alias("filename"), F.col(value).alias("line"))


def per_record(nodes: DataFrame, run: Callable[[list[dict]], Iterable[tuple]], schema: str, keys: tuple[str, ...] = ("cis",)) -> DataFrame:
    """keys and what run() gives of a record's nodes, which it gets in document order.

    nodes: flat ones, gathered by keys first, or records(), where each line is a record of its own.
    """
    heads = "".join(f"{k} string, " for k in keys)
    if "line" in nodes.columns:
        return rows_of(nodes.select(*keys, "line"), lambda *row: (row[:-1] + r for r in run(flatten_record(row[-1]))), heads + schema)
    held = nodes.groupBy(*keys).agg(F.collect_list(F.struct(*_FIELDS)).alias("nodes"))
    return rows_of(held, lambda *row: (row[:-1] + r for r in run(sorted(row[-1], key=lambda n: n["path"]))), heads + schema)


def below(nodes: list[dict], at: int) -> Iterator[dict]:
    """The node at a place of a record's nodes, and those of its subtree, in document order."""
    head = nodes[at]["path"] + "."
    yield nodes[at]
    for n in range(at + 1, len(nodes)):
        if not nodes[n]["path"].startswith(head):
            break
        yield nodes[n]


def nodes(lines: DataFrame, value: str = "value") -> DataFrame:
    """cis, filename and the flat nodes of each record; one walk per record, no recursion in the plan."""
    return per_record(records(lines, value), lambda ns: (tuple(n[f] for f in _FIELDS) for n in ns), NODE, ("cis", "filename"))
