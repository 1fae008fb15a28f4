"""Declared delimited datasets, allow-lists, ground truths and file listings."""

from __future__ import annotations

import json
import shutil
from dataclasses import dataclass
from urllib.request import urlopen

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import decode_bytes

_ENCODINGS = {"latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "utf8": "UTF-8", "utf-8": "UTF-8"}


@dataclass(frozen=True)
class Dataset:
    id: str
    table: str
    url: str
    columns: tuple[str, ...]
    delimiter: str = ","
    encoding: str = "utf-8"
    quote: str = '"'


def catalogue(path: str) -> dict[str, Dataset]:
    """Datasets of a YAML file by id; only CSV sources are known."""
    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f)
    out = {}
    for d in raw["datasets"] if isinstance(raw, dict) else raw:
        source = d["source"]
        if source.get("type", "csv") != "csv":
            raise ValueError(f"unknown source type {source['type']!r}")
        out[d["id"]] = Dataset(d["id"], d.get("table", d["id"]), source.get("url", ""), tuple(c["name"] for c in d["columns"]), source.get("delimiter", ","), source.get("encoding", "utf-8"), source.get("quotechar", '"'))
    return out


def read_dataset(spark: SparkSession, d: Dataset, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a landed file: rows have exactly the declared number of fields; the header is skipped."""
    encoding = _ENCODINGS.get(d.encoding.lower(), d.encoding)
    if encoding in ("cp1252", "windows-1252"):  # Spark's reader has no such name: the file is laid down again as UTF-8
        whole = spark.read.format("binaryFile").load(path).select(decode_bytes(F.col("content")).alias("value"))
        path, encoding = f"{path}.utf8", "UTF-8"
        whole.write.mode("overwrite").option("lineSep", "\n").text(path)
    schema = ", ".join(f"`{c}` string" for c in d.columns) + ", _bad string"
    options = {"header": True, "sep": d.delimiter, "quote": d.quote, "escape": d.quote, "encoding": encoding, "multiLine": True, "columnNameOfCorruptRecord": "_bad", "enforceSchema": True}
    rows = spark.read.schema(schema).options(**options).csv(path)
    # the reader refuses queries of the reject column alone, such as its count: the filter reads another one
    rejects = rows.filter(F.col("_bad").isNotNull() & (F.coalesce(F.length(d.columns[0]), F.lit(0)) >= 0)).withColumnRenamed("_bad", "value")
    return rows.filter("_bad is null").drop("_bad"), rejects


def land(d: Dataset, folder: str, opener=urlopen) -> str:
    """Fetches a dataset's file to a landing folder; returns its path."""
    path = f"{folder}/{d.id}.csv"
    with opener(d.url) as response, open(path, "wb") as out:
        shutil.copyfileobj(response, out)
    return path


def package(spark: SparkSession, path: str, skip: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The CSV resources of a tabular package (datapackage.json) by name, but for those to skip."""
    base = path.rpartition("/")[0]
    described = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))  # one small file
    out = {}
    for r in described["resources"]:
        if r["name"] in skip:
            continue
        kinds = {"integer": "bigint", "number": "double", "boolean": "boolean", "date": "date"}
        schema = ", ".join(f"`{f['name']}` {kinds.get(f.get('type'), 'string')}" for f in r["schema"]["fields"])
        dialect = r.get("dialect", {})
        out[r["name"]] = spark.read.schema(schema).options(header=True, sep=dialect.get("delimiter", ","), encoding=r.get("encoding", "UTF-8"), nullValue="", multiLine=True, escape='"').csv(f"{base}/{r['path']}")
    return out


def publish(tables: dict[str, DataFrame], database: str = "default", drop: tuple[str, ...] = ()) -> None:
    """Drops older tables, then saves each DataFrame as a table of its name."""
    for name in (*drop, *tables):
        next(iter(tables.values())).sparkSession.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    for name, df in tables.items():
        df.write.saveAsTable(f"`{database}`.`{name}`")


def allow_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct all-digit first fields."""
    first = F.trim(F.split_part(F.col(column), F.lit(","), F.lit(1)))
    return lines.select(first.alias("cis")).filter(F.col("cis").rlike("^[0-9]+$")).distinct()


def ground_truth(df: DataFrame) -> DataFrame:
    """cis, true_a, true_b, true_c: by column prefix (A:, B:, C:) where there is one, else by place."""
    pick = {x: next((c for c in df.columns if c.upper().startswith(f"{x.upper()}:")), df.columns[i]) for i, x in enumerate("abc", 1)}
    yes = lambda c: F.coalesce(F.lower(F.trim(F.col(f"`{c}`"))) == "oui", F.lit(False))
    return df.select(F.trim(F.col(f"`{df.columns[0]}`")).alias("cis"), *[yes(c).alias(f"true_{x}") for x, c in pick.items()])


def html_files(spark: SparkSession, folder: str, pattern: str = "N", wanted: DataFrame | None = None) -> DataFrame:
    """path, filename, content of HTML files that start with pattern; wanted (filename) is applied before contents are used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(f"{folder}/*").withColumn("filename", F.element_at(F.split("path", "/"), -1))
    files = files.filter(F.col("filename").startswith(pattern) & F.col("filename").rlike(r"\.html?$"))
    return files.join(wanted.select("filename"), "filename", "left_semi") if wanted is not None else files
