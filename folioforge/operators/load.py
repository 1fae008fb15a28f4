"""Keyed upserts, trees with deterministic ids, lookups in arrays, typed loads."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import code_ancestors, unanchor
from folioforge.operators.evaluate import last_wins
from folioforge.sources.jsonl import per_record

def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The target with incoming rows in place of those of the same key; the last incoming row by order wins."""
    new = last_wins(incoming, keys, order)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*target.columns))

def replace_trees(nodes: DataFrame, incoming: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whole trees are replaced by key; flat nodes need no recursion to delete."""
    return nodes.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)

def importable(nodes: DataFrame) -> DataFrame:
    """Blocks that have content, children or text."""
    return nodes.filter((F.size("content") > 0) | F.col("has_children") | (F.coalesce("text", F.lit("")) != ""))

def with_children(nodes: DataFrame, doc: str = "doc_id", node: str = "node_id", parent: str = "parent_id", pos: str = "pos") -> DataFrame:
    """Adds children: the ids of a node's children, in order."""
    kids = nodes.filter(F.col(parent).isNotNull()).groupBy(doc, F.col(parent).alias(node)).agg(F.transform(F.array_sort(F.collect_list(F.struct(pos, node))), lambda x: x[node]).alias("children"))
    return nodes.join(kids, [doc, node], "left")

def lookup_all(df: DataFrame, key: str, ids: str, table: DataFrame, id_: str, label: str, into: str) -> DataFrame:
    """Adds into: the labels of an array of ids, order and repeats kept, unknown ones left out."""
    each = df.select(key, F.posexplode(ids).alias("pos", id_)).join(table.select(id_, label), id_)
    listed = each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", label))), lambda x: x[label]).alias(into))
    return df.join(listed, key, "left").withColumn(into, F.coalesce(into, F.array().cast("array<string>")))

def lookup_one(df: DataFrame, key: str, table: DataFrame, value: str, default: str = "") -> DataFrame:
    """Adds value, looked up by key; the default where the key has none. table has one row per key."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))

def mapped_files(files: DataFrame, mapping: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """filename, cis of files that the mapping knows and the allow-list has; others never get further."""
    known = mapping.select("filename", "cis")
    known = known if allowed is None else known.join(allowed.select("cis"), "cis", "left_semi")
    return files.join(known, "filename")

def numbered(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds batch: rows in order, `size` to a batch, counted from 0.

    Rows are numbered within ranges of the order; a range's offset is the sum of the counts
    before it, so no task holds more than its range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    part = ranged.withColumn("_part", F.shiftright("_id", 33))
    counts = part.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per partition
    at = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    return part.join(F.broadcast(counts.select("_part", before.alias("_before"))), "_part").withColumn("batch", F.floor(at / size)).select(*df.columns, "batch")

def specialite_docs(groups: DataFrame, substances: DataFrame, pathologies: DataFrame, labels: DataFrame) -> DataFrame:
    """One document per entry of a group: cis_code, spec_name, substances, pathologies, atc_labels.

    groups: specialites (arrays of a code and a name), subs_ids, pathos_codes, atc5_code; the other
    tables: code, label (labels: any number per code). Ids are trimmed; unknown ones are left out;
    of a code that several groups list, the entry of the greatest group by value stays.
    """
    none = F.array().cast("array<string>")
    trimmed = lambda c: F.transform(c, lambda x: F.trim(x))
    key = groups.select(F.unhex(F.sha1(F.to_json(F.struct("*")))).alias("_group"), "specialites", trimmed("subs_ids").alias("subs_ids"), trimmed("pathos_codes").alias("pathos_codes"), "atc5_code").dropDuplicates(["_group"])
    # both lists meet both tables in one join
    clean = lambda t, kind: t.select(F.lit(kind).alias("_kind"), F.trim(F.col("code").cast("string")).alias("code"), "label")
    ids = lambda c, kind: F.transform(F.coalesce(c, none), lambda x, i: F.struct(F.lit(kind).alias("_kind"), i.alias("pos"), x.alias("code")))
    each = key.select("_group", F.inline(F.concat(ids("subs_ids", 0), ids("pathos_codes", 1))))
    found = each.join(clean(substances, 0).unionByName(clean(pathologies, 1)), ["_kind", "code"])
    found = found.groupBy("_group").agg(F.array_sort(F.collect_list(F.struct("_kind", "pos", "label"))).alias("_l"))
    # a code's labels are found once, not once a group
    codes = groups.filter("atc5_code <> ''").select("atc5_code").distinct()
    coded = code_labels(codes, "atc5_code", "atc5_code", labels.select("code", "label"))
    out = key.select("_group", "specialites", "atc5_code").join(found, "_group", "left").join(coded, "atc5_code", "left")
    listed = lambda kind: F.coalesce(F.transform(F.filter("_l", lambda x: x["_kind"] == kind), lambda x: x["label"]), none)
    each = out.select("_group", F.explode("specialites").alias("s"), listed(0).alias("substances"), listed(1).alias("pathologies"), F.coalesce("code_labels", none).alias("atc_labels"))
    docs = each.select("_group", F.try_element_at("s", F.lit(1)).alias("cis_code"), F.try_element_at("s", F.lit(2)).alias("spec_name"), "substances", "pathologies", "atc_labels")
    return last_wins(docs.filter("cis_code is not null"), ["cis_code"], ["_group"]).drop("_group")

META = ("DateNotif", "AmmAnnexeTitre")

def _imported(nodes: list[dict]) -> dict[str, tuple[dict, list[dict]]]:
    """A record's blocks that are kept, and the children of each that are; a block goes with any block above it that is left out."""
    whole: dict[str, tuple[dict, list[dict]]] = {}
    for n in nodes:
        filled = any(n["content"] or []) or n["has_children"]
        kept = filled or n["text"] if n["depth"] else filled and n["type"] not in META
        if kept and (not n["depth"] or n["parent"] in whole):
            whole[n["path"]] = n, []
            if n["depth"]:
                whole[n["parent"]][1].append(n)
    return whole


def _main_rows(nodes: list[dict]) -> Iterator[tuple]:
    last = {n["type"]: n for n in nodes if n["depth"] == 0 and n["type"] in META}
    named = [(((n["content"] or [None])[0] or None, n["path"]) if n else (None, None)) for n in (last.get("AmmAnnexeTitre"), last.get("DateNotif"))]
    if any(n["depth"] == 0 for n in nodes):
        yield (*named[0], *named[1], [{"pos": n["pos"], "path": n["path"]} for n, _ in _imported(nodes).values() if not n["depth"]])


def _content_rows(nodes: list[dict]) -> Iterator[tuple]:
    for n, kids in _imported(nodes).values():
        yield (*(n[c] for c in ("path", "parent", "depth", "pos", "type", "content", "anchor", "html")), [k["path"] for k in sorted(kids, key=lambda k: k["pos"])] or None)


def import_rows(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(main, content, rejects) of flat nodes or records, for a keyed load.

    main: code_cis, title, date_notif (the last top-level block of its type wins; empty: null),
    children; content: code_cis, id, parent_id, pos, type, content, anchor, html (named anchors
    removed), children. Ids follow from the record and the path, so that a record loads the
    same twice. Records without a code count as imported and give no row; rejects: cis,
    filename of records whose code is no whole number.
    """
    named, code = nodes.filter("cis <> ''"), F.expr("try_cast(cis as int)")
    key = ("cis", "filename")
    rejects = per_record(named.filter(code.isNull()), lambda ns: [(len(ns),)] if ns else [], "n int", key).select(*key).distinct()
    good = named.filter(code.isNotNull())
    node_id = lambda path: F.xxhash64("code_cis", path)
    head = per_record(good, _main_rows, "title string, title_at string, date_notif string, date_at string, roots array<struct<pos:int,path:string>>", key).withColumn("code_cis", code)
    head = head.withColumn("roots", F.transform("roots", lambda r: F.struct(r["pos"].alias("pos"), node_id(r["path"]).alias("id"))))
    roots = F.transform(F.array_sort(F.flatten(F.collect_list("roots"))), lambda r: r["id"])
    main = head.groupBy("code_cis").agg(F.max_by("title", "title_at").alias("title"), F.max_by("date_notif", "date_at").alias("date_notif"), roots.alias("children"))
    main = main.withColumn("children", F.when(F.size("children") > 0, F.col("children")))
    rows = per_record(good, _content_rows, "path string, parent string, depth int, pos int, type string, content array<string>, anchor string, html string, kids array<string>", key).withColumn("code_cis", code)
    content = rows.select("code_cis", node_id("path").alias("id"), F.when(F.col("depth") > 0, node_id("parent")).alias("parent_id"), "path", "pos", "type", "content", "anchor", unanchor(F.col("html")).alias("html"), F.transform("kids", node_id).alias("children"))
    return main, content, rejects


def staged(df: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a staged table of texts: the columns in kinds, cast, empty texts as null."""
    return typed(df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in kinds]), {c: k for c, k in kinds.items() if k != "string"})

#: The presentations table's columns; the staging file has one more before them.
PRESENTATIONS = {"numpresentation": "int", "codecip13": "string", "nom_presentation": "string", "numelement": "int", "nomelement": "string", "recipient": "string", "numrecipient": "int", "nbrrecipient": "int", "qtecontenance": "double", "codeunitecontenance": "string", "unitecontenance": "string", "codecaraccomplrecip": "string", "numordreedit": "int", "caraccomplrecip": "string", "numdispositif": "int", "codenaturedispositif": "string", "dispositif": "string"}

def code_labels(df: DataFrame, key: str, code: str, labels: DataFrame) -> DataFrame:
    """key, label list: a code's ancestors, shortest first, each followed by its labels; labels: code, label."""
    up = df.select(key, F.posexplode(code_ancestors(F.col(code))).alias("pos", "code")).join(labels, "code", "left")
    each = up.groupBy(key, "pos", "code").agg(F.array_sort(F.collect_set("label")).alias("l"))
    listed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat(F.array("code"), "l").alias("l")))), lambda x: x["l"]))
    return each.groupBy(key).agg(listed.alias("code_labels"))

def label_sets(*tables: DataFrame) -> DataFrame:
    """code and the sorted set of its labels over tables of (code, label); null codes and labels are left out."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.dropna(subset=["code", "label"]).groupBy("code").agg(F.array_sort(F.collect_set("label")).alias("labels"))

def typed(df: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): text columns cast; a row with a value that doesn't cast is a reject."""
    tried = df.withColumns({f"_{c}": F.expr(f"try_cast(`{c}` as {k})") for c, k in kinds.items()})
    bad = F.lit(False)
    for c in kinds:
        bad = bad | (F.col(c).isNotNull() & F.col(f"_{c}").isNull())
    good = tried.filter(~bad).select(*[F.col(f"_{c}").alias(c) if c in kinds else F.col(c) for c in df.columns])
    return good, tried.filter(bad).select(*df.columns)

def ensure_table(spark: SparkSession, name: str, like: DataFrame) -> None:
    """A table of like's columns, unless there is one of that name."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")

def overwrite_checked(df: DataFrame, path: str) -> int:
    """Truncate and load: the folder's rows are replaced; returns how many were written."""

    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()
