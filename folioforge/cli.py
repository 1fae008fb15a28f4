"""Commands: each one a single Spark job over all its input."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("folioforge")


def session() -> SparkSession:
    return SparkSession.builder.appName("folioforge").config("spark.sql.session.timeZone", "UTC").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()


def parse_html(spark: SparkSession, a: argparse.Namespace) -> None:
    """Leaflets to flat nodes; names outside of the map and the allow-list are never decoded."""
    from folioforge.functions.text import decode_bytes
    from folioforge.sources.datasets import html_files
    from folioforge.sources.html import html_nodes, html_rejects, parsed_pages

    known = _known(spark, a)
    files = html_files(spark, a.folder, a.pattern, known)
    files = files.orderBy("filename").limit(a.limit) if a.limit else files
    pages = files.join(known, "filename") if known is not None else files.withColumn("cis", F.regexp_extract("filename", r"(\d+)", 1))
    parsed = parsed_pages(pages.select(F.concat_ws("|", "cis", "filename").alias("doc"), decode_bytes(F.col("content")).alias("html")), "doc").persist()
    html_nodes(parsed, "doc").write.mode("overwrite").json(a.output)
    html_rejects(parsed).write.mode("overwrite").json(f"{a.output}.rejects")
    parsed.unpersist()


def _known(spark: SparkSession, a: argparse.Namespace) -> DataFrame | None:
    """filename, cis of the map, the last line of a name, within the allow-list; None without a map."""
    from folioforge.operators.evaluate import last_wins
    from folioforge.sources.datasets import allow_list

    if not a.map:
        return None
    known = spark.read.csv(a.map, header=True).select("filename", F.col("cis").cast("string").alias("cis")).withColumn("_o", F.monotonically_increasing_id())
    known = last_wins(known, ["filename"], ["_o"]).drop("_o")
    return known.join(allow_list(spark.read.text(a.allow)), "cis", "left_semi") if a.allow else known


def parse_staged(spark: SparkSession, a: argparse.Namespace) -> None:
    """New files of a staging folder in batches, each to an output of its own, then to the archive."""
    from folioforge.streaming import batches

    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    for at in batches.parse_staged(spark, a.staging, a.output, a.checkpoint, a.pattern, stamp, _known(spark, a), a.archive, a.batch_size):
        log.info("wrote %s", at)


def import_records(spark: SparkSession, a: argparse.Namespace) -> None:
    """Records to main and content rows, replaced by code; with a database, into its tables."""
    from folioforge.operators.evaluate import Counters
    from folioforge.operators.load import import_rows

    main, content, rejects = import_rows(_nodes(spark, a))
    seen = Counters(untitled="title is null")
    seen.watch(main).write.mode("overwrite").parquet(f"{a.output}/main")
    content.write.mode("overwrite").parquet(f"{a.output}/content")
    rejects.write.mode("overwrite").json(f"{a.output}/rejects")
    log.info("imported %(rows)d, without a title %(untitled)d", seen.values())


def specialites(spark: SparkSession, a: argparse.Namespace) -> None:
    """Reference documents, one per code, from the database's tables or from files of the same names."""
    from folioforge.config import Database
    from folioforge.operators.load import specialite_docs
    from folioforge.sources.databases import reference_tables

    if a.tables:
        found = {name: spark.read.parquet(f"{a.tables}/{name}") for name in ("groups", "substances", "pathologies", "labels")}
    else:
        db = Database.from_env("POSTGRESQL", "postgresql", 5432)
        if db is None:
            raise ValueError("neither --tables nor a database is given")
        found = reference_tables(spark, db)
    docs = specialite_docs(**found)
    (docs.orderBy("cis_code").limit(a.limit) if a.limit else docs).write.mode("overwrite").parquet(a.output)


def sql_to_csv(spark: SparkSession, a: argparse.Namespace) -> None:
    from folioforge.sources.sqldump import as_columns, insert_rows

    text = spark.read.format("binaryFile").load(a.dump).select(F.decode("content", a.encoding).alias("value"))
    rows = insert_rows(text)
    first = rows.orderBy("stmt", "row").first()
    if first is None:
        raise ValueError("the dump has no INSERT")
    as_columns(rows.orderBy("stmt", "row"), list(first["cols"])).coalesce(1).write.mode("overwrite").csv(a.output, header=True, nullValue="", emptyValue="")


def import_dataset(spark: SparkSession, a: argparse.Namespace) -> None:
    from folioforge.operators.load import overwrite_checked
    from folioforge.sources.datasets import catalogue, read_dataset

    known = catalogue(a.config)
    for d in [known[a.dataset]] if a.dataset else known.values():
        good, bad = read_dataset(spark, d, f"{a.landing}/{d.id}.csv")
        log.info("%s: %d rows, %d rejects", d.id, overwrite_checked(good, f"{a.output}/{d.table}"), bad.count())


def _nodes(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    from folioforge.sources import jsonl

    good, bad = jsonl.read_lines(spark, a.input)
    good = jsonl.parsed_files(good, "file", a.since)
    good = good.withColumn("_at", F.monotonically_increasing_id()).orderBy("file", "_at").limit(a.limit).drop("_at") if a.limit else good
    bad.write.mode("overwrite").json(f"{a.output}.rejects")
    return jsonl.nodes(good)


def classify(spark: SparkSession, a: argparse.Namespace) -> None:
    from folioforge.operators import evaluate, labels
    from folioforge.operators.sections import texts_of_sections
    from folioforge.sources.datasets import ground_truth

    nodes = _nodes(spark, a)
    texts = texts_of_sections(nodes.filter("cis <> ''"), {"4.1": "t1", "4.2": "t2", "4.3": "texts_contra"})
    empty = F.array().cast("array<string>")
    texts = texts.withColumn("texts_main", F.concat(F.coalesce("t1", empty), F.coalesce("t2", empty)))
    codes = spark.read.csv(a.codes, header=True).select("cis", "code") if a.codes else spark.createDataFrame([], "cis string, code string")
    done = labels.classify(texts.join(codes.dropDuplicates(["cis"]), "cis", "left"), rules=labels.Rules(strict=a.strict))
    rows = labels.report_rows(done, "cis").join(codes.dropDuplicates(["cis"]).select("cis", "code"), "cis", "left").withColumn("code", F.coalesce("code", F.lit("")))
    if a.debug:
        joined = [F.array_join(F.coalesce(c, empty), "\n").alias(f"texts_{n}") for c, n in (("t1", "4_1"), ("t2", "4_2"), ("texts_contra", "4_3"))]
        texts.select("cis", *joined).write.mode("overwrite").json(f"{a.output}.debug.jsonl")
    if a.truth:
        truth = evaluate.last_wins(ground_truth(spark.read.csv(a.truth, header=True)).withColumn("o", F.monotonically_increasing_id()), ["cis"], ["o"]).drop("o")
        rows = evaluate.with_truth(rows, truth, "cis")
        pairs = done.select("cis", *[F.col(f"label_{x}").alias(f"pred_{x}") for x in "abc"]).join(truth, "cis")
        print(evaluate.report(evaluate.confusion(pairs, list("abc")), evaluate.exact_match(pairs, list("abc"))))
    (rows.coalesce(1) if a.single else rows).write.mode("overwrite").csv(a.output, header=True)


def index(spark: SparkSession, a: argparse.Namespace) -> None:
    from folioforge.operators import search, sections
    from folioforge.operators.evaluate import last_wins

    nodes = _nodes(spark, a)
    if a.target == "chunks":
        chunks = last_wins(sections.notice_chunks(nodes), ["id"], ["embed_text"])
        hashes = nodes.groupBy(F.col("cis").alias("key")).agg(search.content_hash(F.to_json(F.array_sort(F.collect_list(F.struct("path", "type", "content", "anchor", "html"))))).alias("content_hash"))
        chunks = chunks.withColumn("key", F.col("cis")).join(hashes, "key")
        cache = spark.read.parquet(a.load_embeddings) if a.load_embeddings else None
        out = search.embed_cached(chunks if cache is None else chunks.persist(), cache, batch=a.batch)
        out.write.mode("overwrite").parquet(a.output)
        if a.save_embeddings:
            search.save_cache(spark.read.parquet(a.output), a.save_embeddings)
        return
    else:
        names = spark.read.csv(a.names, header=True).select("cis", "name") if a.names else spark.createDataFrame([], "cis string, name string")
        out = last_wins(sections.section_docs(nodes, names, a.doc_type), ["id"], ["path"]).drop("path")
    out.write.mode("overwrite").parquet(a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioforge")
    p.add_argument("--verbose", action="store_true")
    sub = p.add_subparsers(dest="command")

    def command(name, run, *flags):
        c = sub.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for flag, options in flags:
            c.add_argument(flag, **options)
        c.add_argument("-o", "--output", required=True)
        c.set_defaults(run=run)

    record = (("--input", {"required": True}), ("--since", {}), ("--limit", {"type": int}))
    command("parse-html", parse_html, ("folder", {}), ("--pattern", {"default": "N", "choices": ["N", "R"]}), ("--map", {}), ("--allow", {}), ("--limit", {"type": int}))
    command("sql-to-csv", sql_to_csv, ("dump", {}), ("--encoding", {"default": "ISO-8859-1"}))
    command("import-dataset", import_dataset, ("--config", {"required": True}), ("--dataset", {}), ("--landing", {"required": True}))
    command("classify", classify, *record, ("--truth", {}), ("--codes", {}), ("--strict", {"action": "store_true"}), ("--debug", {"action": "store_true"}), ("--single", {"action": "store_true"}))
    command("parse-staged", parse_staged, ("staging", {}), ("--checkpoint", {"required": True}), ("--archive", {}), ("--pattern", {"default": "N", "choices": ["N", "R"]}), ("--map", {}), ("--allow", {}), ("--batch-size", {"type": int, "default": 500}))
    command("import-records", import_records, *record)
    command("specialites", specialites, ("--tables", {}), ("--limit", {"type": int}))
    command("index", index, ("target", {"choices": ["sections", "chunks"]}), *record, ("--doc-type", {"default": "rcp", "choices": ["rcp", "notice"]}), ("--names", {}), ("--batch", {"type": int, "default": 64}), ("--load-embeddings", {}), ("--save-embeddings", {}))
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO)
    if not a.command:
        p.print_help()
        return 1
    try:
        a.run(session(), a)
    except Exception:
        log.exception("%s failed", a.command)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
