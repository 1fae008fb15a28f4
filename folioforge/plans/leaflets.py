"""Registered queries that run the library's own parser, sections, chunks, readers and loads.

The provided tables hold no leaflets, so these are built from the lines of the documents (or
from other tables' rows) by a rule on each line's position; the SQL says from the same lines
what the library has to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.config import scratch
from folioforge.functions import text as tx
from folioforge.operators import evaluate, labels, load, search, sections
from folioforge.plans.catalogue import _LINES_SQL, _RULES, LABELS_TAIL, _query, _t
from folioforge.sources import databases, datasets, jsonl
from folioforge.sources import html as html_source

_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WHITE}|{_WHITE}$', '', 'g')"


_PLAIN = "replace(replace(translate(line, '’‘‑–', '''''--'), '≥', '>='), '≤', '<=')"

# ------------------------------------------------------------------------- pages

#: Every sixth line a level-1 title, then a level-2 one, a paragraph, two bullets, a bold line.
_KINDS = ("AmmAnnexeTitre1", "AmmAnnexeTitre2", "AmmCorpsTexte", "AmmListePuces1", "AmmListePuces1", "AmmCorpsTexteGras")
_PAGE_SQL = "WITH " + _LINES_SQL + f", x AS (SELECT doc_id, pos, pos % 6 AS k, {_PLAIN} AS t FROM lines)"


def _pages(spark, sf) -> DataFrame:
    escaped = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    tags = F.transform(F.split(escaped, "\n"), lambda x, i: F.concat(F.lit('<p class="'), F.element_at(kinds, i % 6 + 1), F.lit('">'), x, F.lit("</p>")))
    return _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("<html><body>"), F.array_join(tags, "\n"), F.lit("</body></html>")).alias("html"))


@_query(_PAGE_SQL + """ SELECT doc_id, pos AS node_pos, pos - k AS t1_pos, CASE WHEN k > 0 THEN pos - k + 1 END AS t2_pos,
CASE k WHEN 0 THEN 'AmmAnnexeTitre1' WHEN 1 THEN 'AmmAnnexeTitre2' WHEN 2 THEN 'AmmCorpsTexte' ELSE 'AmmCorpsTexteGras' END AS type, md5(t) AS h FROM x WHERE k NOT IN (3, 4)""")
def section_tree(spark, sf):
    """Titles and paragraphs of a page, under their sections."""
    n = html_source.html_nodes(_pages(spark, sf), "doc_id").filter("type <> 'listePuce'")
    return n.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("node_pos", "t1_pos", "t2_pos")], "type", F.md5(F.array_join("content", "|").cast("binary")).alias("h"))


@_query(_PAGE_SQL + " SELECT doc_id, pos - k + 3 AS node_pos, pos - k AS t1_pos, count(*) AS n, md5(string_agg(t, '|' ORDER BY pos)) AS h FROM x WHERE k IN (3, 4) AND t <> '' GROUP BY doc_id, pos - k")
def bullet_runs(spark, sf):
    """Runs of bullets of a page, empty ones left out."""
    n = html_source.html_nodes(_pages(spark, sf), "doc_id").filter("type = 'listePuce'")
    return n.select("doc_id", F.col("node_pos").cast("long").alias("node_pos"), F.col("t1_pos").cast("long").alias("t1_pos"), F.size("content").cast("long").alias("n"), F.md5(F.array_join("content", "|").cast("binary")).alias("h"))


@_query("""WITH c AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i FROM nation)
SELECT n_regionkey, CASE WHEN i = 0 THEN 'thead' ELSE 'tbody' END AS part, greatest(i - 1, 0)::BIGINT AS r, c.j::BIGINT AS c, CASE WHEN i = 0 THEN 'th' ELSE 'td' END AS tag, CASE WHEN c.j = 0 THEN n_nationkey::VARCHAR ELSE n_name END AS text, CASE WHEN i > 0 AND c.j = 1 THEN 'bold' ELSE '' END AS styles
FROM (SELECT c.*, unnest([0, 1]) AS j FROM c) c""")
def table_cells(spark, sf):
    """A table of each region's nations: the first as its head, the others as rows with a bold name."""
    cell = lambda tag, x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    row = lambda tag, name: lambda r: cell("tr", F.concat(cell(tag, r["n_nationkey"].cast("string")), cell(tag, name(r["n_name"]))))
    bold = lambda x: F.concat(F.lit("<p><b>"), x, F.lit("</b></p>"))
    pages = _t(spark, sf, "nation").groupBy("n_regionkey").agg(rows.alias("r"))
    head = F.concat(F.lit("<thead>"), row("th", lambda x: x)(F.element_at("r", 1)), F.lit("</thead><tbody>"))
    body = F.array_join(F.transform(F.slice("r", 2, 10_000), row("td", bold)), "")
    pages = pages.select("n_regionkey", F.concat(F.lit('<table class="AmmCorpsTexteTable">'), head, body, F.lit("</tbody></table>")).alias("html"))
    c = html_source.html_nodes(pages, "n_regionkey").filter("type = 'table'").select("n_regionkey", F.explode("cells").alias("c"))
    kid = F.flatten(F.transform("c.children", lambda k: k["styles"]))
    return c.select("n_regionkey", "c.part", F.col("c.row").cast("long").alias("r"), F.col("c.col").cast("long").alias("c"), "c.tag", "c.text", F.array_join(kid, ",").alias("styles"))


# ----------------------------------------------------------------------- records

_BLOCK = "struct<type:string,anchor:string,content:string,children:array<struct<type:string,anchor:string,content:string,children:array<struct<type:string,content:string>>>>>"


def _records(spark, sf, section: str, head: str = "array()") -> DataFrame:
    """value: a document as a record; section: a block's fields, an expression of its lines l and its number s.

    A section has up to four lines: the first is its title's, the others lie below it.
    """
    docs = _t(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    listed = f"transform(sequence(0, cast(ceil(size(l) / 4) as int) - 1), s -> cast({section} as {_BLOCK}))"
    meta = f"cast({head} as array<{_BLOCK}>)"
    return docs.select(F.expr(f"to_json(named_struct('source', named_struct('cis', cast(doc_id as string), 'filename', concat('R', doc_id)), 'content', concat({meta}, {listed})))").alias("value"))


def _s(kind: str, anchor: str, content: str, children: str) -> str:
    return f"named_struct('type', '{kind}', 'anchor', {anchor}, 'content', {content}, 'children', {children})"


_NONE, _NO_KIDS = "cast(null as string)", "cast(null as array<struct<type:string,content:string>>)"
_NO_BLOCKS = "cast(null as array<struct<type:string,anchor:string,content:string,children:array<struct<type:string,content:string>>>>)"
_HEAD = f"""array({_s('AmmAnnexeTitre', _NONE, "concat('doc', doc_id)", _NO_BLOCKS)}, {_s('DateNotif', _NONE, "concat('0', doc_id)", _NO_BLOCKS)})"""
_TITLE = "concat('H', s, ' ', l[4 * s])"
_BODY = f"transform(slice(l, 4 * s + 2, 3), x -> {_s('AmmCorpsTexte', _NONE, 'x', _NO_KIDS)})"
_UNDER = "transform(slice(l, 4 * s + 3, 2), x -> named_struct('type', 'AmmCorpsTexte', 'content', x))"
_SECTIONS_SQL = "WITH " + _LINES_SQL + """, g AS (SELECT doc_id, pos // 4 AS s, list(line ORDER BY pos) AS l FROM lines GROUP BY doc_id, pos // 4)"""
_SUB = _s("AmmAnnexeTitre2", "'_Toc'", "concat('4.', s % 9 + 1, '. ', l[4 * s + 1])", _UNDER)
#: Sections with an even number have a numbered and anchored subsection with all but the first line.
_RCP = f"""if(s % 2 = 0 and size(l) > 4 * s + 1,
{_s('AmmAnnexeTitre1', "concat('_T', s)", _TITLE, f"array({_SUB})")},
{_s('AmmAnnexeTitre1', "concat('Sec', s)", _TITLE, _BODY)})"""
_NUMBER_SQL = "CASE s % 9 " + " ".join(f"WHEN {i} THEN '{sections.RCP_NUMBERS[f'4.{i + 1}']}'" for i in range(9)) + " END"
_JOINED = f"array_to_string([x FOR x IN [{_strip('y')} FOR y IN parts] IF x <> ''], ' ')"


@_query(_SECTIONS_SQL + f""", e AS (SELECT doc_id, s, s % 2 = 0 AND len(l) > 1 AS two, l,
CASE WHEN s % 2 = 0 AND len(l) > 1 THEN list_concat(['4.' || (s % 9 + 1) || '. ' || l[2]], l[3:4]) ELSE list_concat(['H' || s || ' ' || l[1]], l[2:4]) END AS parts FROM g),
d AS (SELECT doc_id, s, CASE WHEN two THEN {_NUMBER_SQL} ELSE 'Sec' || s END AS anchor, CASE WHEN two THEN 'AmmAnnexeTitre2' ELSE 'AmmAnnexeTitre1' END AS section_type, {_strip('parts[1]')} AS title, {_JOINED} AS body FROM e)
SELECT doc_id || '_' || anchor || '_rcp' AS id, CASE WHEN doc_id % 2 = 0 THEN 'N' || doc_id ELSE '' END AS spec_name, arg_max(section_type, s) AS section_type, md5(arg_max(title, s)) AS title, md5(arg_max(body, s)) AS body, '0' || doc_id AS date_notif FROM d GROUP BY doc_id, anchor""")
def section_docs_rcp(spark, sf):
    """Section documents of records, the last one of an id."""
    n = jsonl.records(_records(spark, sf, _RCP, _HEAD))
    names = _t(spark, sf, "documents").filter("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("cis"), F.concat(F.lit("N"), "doc_id").alias("name"))
    docs = evaluate.last_wins(sections.section_docs(n, names, "rcp"), ["id"], ["path"])
    return docs.select("id", "spec_name", "section_type", F.md5(F.col("section_title").cast("binary")).alias("title"), F.md5(F.col("text_content").cast("binary")).alias("body"), "date_notif")


#: A date in place of each third section; sections are named by their number.
_DATED = f"""if(s % 3 = 2, {_s('DateNotif', _NONE, "concat('d', s)", _NO_BLOCKS)}, {_s('AmmNoticeTitre1', "concat('Sec', s)", _TITLE, _BODY)})"""


@_query(_SECTIONS_SQL + f""", e AS (SELECT doc_id, s, list_concat(['H' || s || ' ' || l[1]], l[2:4]) AS parts FROM g WHERE s % 3 <> 2)
SELECT doc_id || '_Sec' || s || '_notice' AS id, CASE WHEN s >= 3 THEN 'd' || (s - s % 3 - 1) ELSE '' END AS date_notif, md5({_JOINED}) AS body FROM e""")
def carry_forward(spark, sf):
    """Section documents of notices: a date reaches only what follows it."""
    n = jsonl.records(_records(spark, sf, _DATED))
    docs = sections.section_docs(n, spark.createDataFrame([], "cis string, name string"), "notice")
    return docs.select("id", "date_notif", F.md5(F.col("text_content").cast("binary")).alias("body"))


#: Numbered sections: even ones are flat (text, bold line, text), odd ones have a subsection.
_FLAT = f"transform(slice(l, 4 * s + 2, 3), (x, i) -> named_struct('type', if(i = 1, 'AmmCorpsTexteGras', 'AmmCorpsTexte'), 'anchor', {_NONE}, 'content', x, 'children', {_NO_KIDS}))"
_DEEP = f"transform(slice(l, 4 * s + 2, 1), x -> {_s('AmmAnnexeTitre2', _NONE, 'x', _UNDER)})"
_CHUNKED = _s("AmmNoticeTitre1", "'_N'", "concat(s % 6 + 1, '. ', l[4 * s])", f"if(s % 2 = 0, {_FLAT}, {_DEEP})")
_NOTICE_SQL = "CASE s % 6 " + " ".join(f"WHEN {i} THEN '{sections.NOTICE_NUMBERS[str(i + 1)]}'" for i in range(6)) + " END"
_CHUNK_SQL = _SECTIONS_SQL + f""", t AS (SELECT doc_id, s, {_NOTICE_SQL} AS anchor, {_strip("(s % 6 + 1) || '. ' || l[1]")} AS title, l FROM g WHERE s % 6 <> 5),
c AS (SELECT doc_id, anchor, title, '' AS sub, {_strip('l[2]')} AS body FROM t WHERE s % 2 = 0 UNION ALL SELECT doc_id, anchor, title, {_strip('l[3]')}, {_strip('l[4]')} FROM t WHERE s % 2 = 0
UNION ALL SELECT doc_id, anchor, title, {_strip('l[2]')}, {_strip(f"{_strip('coalesce(l[3], {0})')} || ' ' || {_strip('coalesce(l[4], {0})')}").replace('{0}', "''")} FROM t WHERE s % 2 = 1)
SELECT """


def _chunks(spark, sf) -> DataFrame:
    return sections.notice_chunks(jsonl.records(_records(spark, sf, _CHUNKED)))


@_query(_CHUNK_SQL + "doc_id, anchor, md5(title) AS title, md5(sub) AS sub, md5(body) AS body FROM c WHERE body <> ''")
def flat_chunks(spark, sf):
    """Chunks of records: by bold lines where a section is flat, else by subsection; those on packing are left out."""
    md5 = lambda c, n: F.md5(F.col(c).cast("binary")).alias(n)
    return _chunks(spark, sf).select(F.col("cis").cast("long").alias("doc_id"), F.col("section_anchor").alias("anchor"), md5("section_title", "title"), md5("sub_header", "sub"), md5("text", "body"))


@_query(_CHUNK_SQL + "doc_id || '_' || anchor || '_' || left(md5(CASE WHEN sub <> '' THEN title || ' > ' || sub || ': ' || body ELSE title || ': ' || body END), 8) AS id FROM c WHERE body <> ''")
def chunk_ids(spark, sf):
    return _chunks(spark, sf).select("id")


@_query(_CHUNK_SQL + "doc_id, count(DISTINCT e) AS n, count(DISTINCT e) FILTER (doc_id % 3 <> 0) AS cached FROM (SELECT doc_id, anchor || chr(31) || CASE WHEN sub <> '' THEN title || ' > ' || sub || ': ' || body ELSE title || ': ' || body END AS e FROM c WHERE body <> '') GROUP BY doc_id")
def embedding_cache(spark, sf):
    """Chunks embedded with a cache on disk: that of every third document is stale, so all its chunks are embedded again."""
    now, kept = _chunks(spark, sf).select("id", F.col("cis").alias("key"), "embed_text").distinct(), scratch(spark)
    now.withColumn("content_hash", search.content_hash(F.concat("key", F.lit("now")))).write.parquet(kept)
    now = spark.read.parquet(kept)  # the records are walked once
    small = lambda texts: search.hashing_embedder(texts, 8)
    at = scratch(spark)
    stale = F.when(F.col("key").cast("long") % 3 == 0, "old").otherwise(F.col("content_hash"))
    search.save_cache(search.embed(now.withColumn("content_hash", stale), small), at, 4)
    done = search.embed_cached(now, spark.read.parquet(at), embedder=small)
    return done.filter("size(embedding) = 8").groupBy(F.col("key").cast("long").alias("doc_id")).agg(F.count("*").alias("n"), F.count_if("cached").alias("cached"))


def _thirds(spark, sf) -> DataFrame:
    """Records with sections 4.1, 4.2 and 4.3 that share a document's lines by turns."""
    kid = lambda i: f"named_struct('type', 'AmmAnnexeTitre2', 'anchor', cast(null as string), 'content', '4.{i + 1} T', 'children', transform(filter(l, (x, i) -> i % 3 = {i}), x -> named_struct('type', 'AmmCorpsTexte', 'content', x)))"
    docs = _t(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    top = f"named_struct('type', 'AmmAnnexeTitre1', 'content', '4. Top', 'children', array({kid(0)}, {kid(1)}, {kid(2)}))"
    return jsonl.records(docs.select(F.expr(f"to_json(named_struct('source', named_struct('cis', cast(doc_id as string)), 'content', array({top})))").alias("value")))


_THIRD_SQL = "t AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents), z AS (SELECT doc_id, " + ", ".join(f"[x FOR x IN [{_strip('y')} FOR y, i IN a IF i % 3 = {(i + 1) % 3}] IF x <> ''] AS l{i}" for i in range(3)) + " FROM t)"


@_query("WITH " + _THIRD_SQL + " SELECT doc_id, len(l0)::BIGINT AS n, md5(array_to_string(l0, '|')) AS h FROM z")
def first_match_section(spark, sf):
    """The texts below the first title 4.1."""
    found = sections.texts_of_section(_thirds(spark, sf), "4.1", "t")
    ids = _t(spark, sf, "documents").select("doc_id")
    texts = F.coalesce("t", F.array().cast("array<string>"))
    return ids.join(found.select(F.col("cis").cast("long").alias("doc_id"), "t"), "doc_id", "left").select("doc_id", F.size(texts).cast("long").alias("n"), F.md5(F.array_join(texts, "|").cast("binary")).alias("h"))


@_query("WITH " + _THIRD_SQL + ", p AS (SELECT doc_id, [lower(x) FOR x IN list_concat(l0, l1)] AS m, [lower(x) FOR x IN l2] AS x, array_to_string([lower(x) FOR x IN list_concat(l0, l1)], ' ') AS j FROM z), " + LABELS_TAIL + " SELECT doc_id, contains(final, 'A')::INTEGER AS label_a, contains(final, 'B')::INTEGER AS label_b, contains(final, 'C')::INTEGER AS label_c FROM r")
def classified_records(spark, sf):
    """Records to labels: section texts, rules, flat report rows."""
    n, empty = _thirds(spark, sf), F.array().cast("array<string>")
    texts = sections.texts_of_sections(n, {"4.1": "t1", "4.2": "t2", "4.3": "texts_contra"})
    texts = texts.withColumns({"texts_main": F.concat(F.coalesce("t1", empty), F.coalesce("t2", empty)), "code": F.lit(None).cast("string")})
    rows = labels.report_rows(labels.classify(texts, rules=_RULES), "cis")
    return rows.select(F.col("cis").cast("long").alias("doc_id"), "label_a", "label_b", "label_c")


@_query(_SECTIONS_SQL + " SELECT doc_id::INTEGER AS code_cis, 'doc' || doc_id AS title, '0' || doc_id AS date_notif, count(*) AS n_children FROM g GROUP BY doc_id")
def import_main(spark, sf):
    """Main rows of records: title and date from the last block of their types, ids of the sections."""
    main, _, _ = load.import_rows(jsonl.records(_records(spark, sf, _RCP, _HEAD)))
    return main.select("code_cis", "title", "date_notif", F.size("children").cast("long").alias("n_children"))


@_query(_SECTIONS_SQL + """, e AS (SELECT *, s % 2 = 0 AND len(l) > 1 AS two FROM g),
b AS (SELECT doc_id, s, 'AmmAnnexeTitre1' AS type, 'H' || s || ' ' || l[1] AS t, CASE WHEN two THEN 1 ELSE len([x FOR x IN l[2:4] IF x <> '']) END AS kids FROM e
UNION ALL SELECT doc_id, s, 'AmmAnnexeTitre2', '4.' || (s % 9 + 1) || '. ' || l[2], len([x FOR x IN l[3:4] IF x <> '']) FROM e WHERE two
UNION ALL SELECT doc_id, s, 'AmmCorpsTexte', unnest([x FOR x IN CASE WHEN two THEN l[3:4] ELSE l[2:4] END IF x <> '']), 0 FROM e)
SELECT doc_id::INTEGER AS code_cis, type, md5(t) AS h, kids::BIGINT AS kids FROM b""")
def import_content(spark, sf):
    """Content rows of records: empty blocks are left out, each row lists its children."""
    _, content, _ = load.import_rows(jsonl.records(_records(spark, sf, _RCP, _HEAD)))
    kids = F.when(F.col("children").isNull(), 0).otherwise(F.size("children"))
    return content.select("code_cis", "type", F.md5(F.array_join("content", "|").cast("binary")).alias("h"), kids.cast("long").alias("kids"))


@_query("SELECT count(*) AS n, count(*) FILTER (doc_id % 5 = 0)::BIGINT AS rejected FROM documents WHERE doc_id % 7 <> 0")
def import_rejects(spark, sf):
    """Records whose code is no number are rejects, those without any are passed over; both are counted by the way."""
    code = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 5 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    block = F.array(F.struct(F.lit("b").alias("type"), F.lit("t").alias("content")))
    lines = _t(spark, sf, "documents").select(F.to_json(F.struct(F.struct(code.alias("cis"), F.col("doc_id").cast("string").alias("filename")).alias("source"), block.alias("content"))).alias("value"))
    main, _, bad = load.import_rows(jsonl.records(lines))
    seen = evaluate.Counters(rejected="bad")
    both = main.select(F.lit(False).alias("bad")).unionAll(bad.select(F.lit(True).alias("bad")))
    seen.watch(both).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.values()["rows"], seen.values()["rejected"])], "n long, rejected long")


# --------------------------------------------------------------- readers and lookups


@_query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, 0::BIGINT AS rejected FROM events WHERE json_valid(props) AND event_id % 10 <> 3 UNION ALL SELECT NULL, NULL, count(*) FROM events WHERE json_valid(props) AND event_id % 10 = 3")
def json_props(spark, sf):
    """Lines of JSON, blank and broken ones among them, through files and the lenient reader."""
    at = scratch(spark)
    line = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("{"), "props")).otherwise(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"p":'), "props", F.lit("}")))
    lines = _t(spark, sf, "events").filter(F.try_parse_json("props").isNotNull()).select(F.explode(F.array(line, F.lit(" "))).alias("value"))
    lines.write.text(at)
    good, bad = jsonl.read_lines(spark, at)
    rows = good.select(F.try_variant_get("record", "$.id", "long").alias("event_id"), F.try_variant_get("record", "$.p.k", "long").alias("k"), F.lit(0).cast("long").alias("rejected"))
    return rows.unionAll(bad.agg(F.lit(None).cast("long"), F.lit(None).cast("long"), F.count("*")))


@_query("SELECT r_regionkey::VARCHAR AS r_regionkey, r_name, (SELECT 2 * count(*) FROM region) AS rejected FROM region")
def csv_arity_filter(spark, sf):
    """A declared file: lines of two fields (one quoted, with a separator and a line break in it), among lines of one and three."""
    at = scratch(spark)
    name = F.concat(F.lit('"'), "r_name", F.lit('"'))
    good = F.concat_ws(";", F.col("r_regionkey").cast("string"), name)
    lines = _t(spark, sf, "region").coalesce(1).select(F.explode(F.array(good, F.col("r_name"), F.concat(good, F.lit(";x")))).alias("value"))
    head = spark.createDataFrame([("key;name",)], "value string")
    head.unionAll(lines).coalesce(1).write.text(at)
    rows, rejects = datasets.read_dataset(spark, datasets.Dataset("region", "region", "", ("r_regionkey", "r_name"), ";", "utf-8"), at)
    n = rejects.count()
    return rows.withColumn("rejected", F.lit(n).cast("long"))


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def allow_list_semi(spark, sf):
    """Orders of listed customers; the list is lines of text, some with more fields, some that are no codes."""
    code = F.col("c_custkey").cast("string")
    lines = _t(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.explode(F.array(F.concat(F.lit(" "), code, F.lit(" , x")), code, F.concat(F.lit("c"), code))).alias("value"))
    allowed = datasets.allow_list(lines).select(F.col("cis").cast("long").alias("o_custkey"))
    return _t(spark, sf, "orders").select("o_orderkey", "o_custkey").join(allowed, "o_custkey", "left_semi")


@_query("SELECT c_custkey, coalesce(max(o_orderpriority), '') AS priority FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def lookup_default(spark, sf):
    top = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("priority"))
    return load.lookup_one(_t(spark, sf, "customer").select("c_custkey"), "c_custkey", top, "priority")


@_query("""SELECT doc_id::VARCHAR AS cis, quality = 1 AS true_a, toxic = 1 AS true_b, false AS true_c FROM labels""")
def truth_table(spark, sf):
    """A ground truth by its columns' prefixes, in another order than theirs."""
    yes = lambda c: F.when(c, " OUI ").otherwise("non")
    t = _t(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("CIS"), F.lit("non").alias("C:x"), yes(F.col("toxic") == 1).alias("B:y"), yes(F.col("quality") == 1).alias("A:z"))
    return datasets.ground_truth(t)


@_query("""SELECT p_name AS filename, max(l_suppkey)::VARCHAR AS cis FROM (SELECT p_name, l_suppkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC, l_suppkey::VARCHAR DESC) AS r FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE r = 1 GROUP BY p_name""")
def database_filename_map(spark, sf):
    """Links and documents joined to file names, the last one of a name."""
    links = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("DocId"), F.col("l_suppkey").alias("SpecId"))
    docs = _t(spark, sf, "part").select(F.col("p_partkey").alias("DocId"), F.concat(F.lit("a/b/"), "p_name").alias("DocPath"))
    return databases.filename_map(links, docs)


@_query("""SELECT o.o_orderkey, p.p_name AS filename FROM orders o JOIN part p ON o.o_orderkey = p.p_partkey WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def mapped_files(spark, sf):
    """Files that the mapping knows and whose code is authorised."""
    spec = _t(spark, sf, "customer").select(F.col("c_custkey").alias("SpecId"), (F.col("c_acctbal") > 0).alias("isBdm"))
    mapping = _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("filename"), F.col("o_custkey").cast("string").alias("cis"))
    files = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("filename"), "p_name")
    return load.mapped_files(files, mapping, databases.authorised(spec)).select(F.col("filename").cast("long").alias("o_orderkey"), F.col("p_name").alias("filename"))


@_query("""WITH u AS (SELECT left(p_brand, n) AS c, n FROM (SELECT DISTINCT p_brand, unnest([1, 3, 4, 5, 7]) AS n FROM part) WHERE n <= length(p_brand)),
k AS (SELECT DISTINCT c, n FROM u), l AS (SELECT c, n, ['l1 ' || c] || CASE WHEN n > 3 THEN ['l2 ' || c] ELSE [] END AS ls FROM k)
SELECT p_partkey, array_to_string(flatten(list(CASE WHEN n = 4 THEN [c] ELSE [c] || ls END ORDER BY n)), '|') AS labels FROM (SELECT p_partkey, p_brand, unnest([1, 3, 4, 5, 7]) AS m FROM part) JOIN l ON m = n AND left(p_brand, m) = c AND m <= length(p_brand) GROUP BY p_partkey""")
def code_ancestor_labels(spark, sf):
    """Ancestors of a code, each with its labels: one, two or (at four characters) none."""
    parts = _t(spark, sf, "part").select("p_partkey", "p_brand")
    known = parts.select(F.explode(tx.code_ancestors(F.col("p_brand"))).alias("code")).distinct().filter("length(code) <> 4")
    named = known.select("code", F.explode(F.when(F.length("code") > 3, F.array(F.lit("l2 "), F.lit("l1 "))).otherwise(F.array(F.lit("l1 ")))).alias("p")).select("code", F.concat("p", "code").alias("label"))
    return load.code_labels(parts, "p_partkey", "p_brand", named).select("p_partkey", F.array_join("code_labels", "|").alias("labels"))


@_query("""WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS supp FROM lineitem GROUP BY l_orderkey),
n AS (SELECT l_orderkey, string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS substances FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
s AS (SELECT l_orderkey, string_agg(s_name, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS pathologies FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_suppkey % 2 = 0 GROUP BY l_orderkey)
SELECT l_orderkey || x AS cis_code, 'n' || x AS spec_name, coalesce(substances, '') AS substances, coalesce(pathologies, '') AS pathologies, CASE WHEN l_orderkey % 2 = 0 THEN 'A|top|A01' ELSE '' END AS atc_labels
FROM l LEFT JOIN n USING (l_orderkey) LEFT JOIN s USING (l_orderkey), (SELECT unnest(['a', 'b']) AS x)""")
def specialite_docs(spark, sf):
    """Reference documents: two codes an order, its parts as substances, its suppliers (half of them known) as pathologies."""
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("lines")
    ids = lambda c: F.transform("lines", lambda x: F.concat(F.lit(" "), x[c].cast("string")))
    g = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(lines).select("l_orderkey", ids("l_partkey").alias("subs_ids"), ids("l_suppkey").alias("pathos_codes"))
    entry = lambda x: F.array(F.concat(F.col("l_orderkey").cast("string"), F.lit(x)), F.lit(f"n{x}"))
    g = g.select(F.array(entry("a"), entry("b")).alias("specialites"), "subs_ids", "pathos_codes", F.when(F.col("l_orderkey") % 2 == 0, "A01").alias("atc5_code"))
    pick = lambda t, k, v: _t(spark, sf, t).select(F.col(k).alias("code"), F.col(v).alias("label"))
    atc = spark.createDataFrame([("A", "top")], "code string, label string")
    docs = load.specialite_docs(g, pick("part", "p_partkey", "p_name"), pick("supplier", "s_suppkey", "s_name").filter("code % 2 = 0"), atc)
    joined = lambda c: F.array_join(c, "|").alias(c)
    return docs.select("cis_code", "spec_name", joined("substances"), joined("pathologies"), joined("atc_labels"))


@_query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders")
def batch_numbers(spark, sf):
    return load.numbered(_t(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 500)


@_query("SELECT p_partkey::INTEGER AS numpresentation, p_name AS nom_presentation, p_retailprice AS qtecontenance, CASE WHEN p_size % 2 = 0 THEN p_size::INTEGER END AS numelement, (SELECT count(*) FROM part WHERE p_partkey % 10 = 3) AS rejected FROM part WHERE p_partkey % 10 <> 3")
def staged_presentations(spark, sf):
    """A staged table of texts, cast on load: empty texts are null, what doesn't cast is rejected."""
    text = {c: F.lit("") for c in ("req_2_recipientcodevu", *load.PRESENTATIONS)}
    text |= {"numpresentation": F.when(F.col("p_partkey") % 10 == 3, "x").otherwise(F.col("p_partkey").cast("string")), "nom_presentation": F.col("p_name"), "qtecontenance": F.col("p_retailprice").cast("string"), "numelement": F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("")}
    rows, rejects = load.staged(_t(spark, sf, "part").select(*[v.alias(k) for k, v in text.items()]), load.PRESENTATIONS)
    return rows.select("numpresentation", "nom_presentation", "qtecontenance", "numelement", F.lit(rejects.count()).cast("long").alias("rejected"))


@_query("""WITH d AS (SELECT doc_id, lang, source, length(text) // 1000 AS size FROM documents), u AS (SELECT doc_id, lang, 'source' AS facet, source AS term FROM d UNION ALL SELECT doc_id, lang, 'size', size::VARCHAR FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, facet, term ORDER BY doc_id) AS r FROM u),
c AS (SELECT lang, facet, term, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (r <= 5) AS top_ids FROM k GROUP BY lang, facet, term),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, facet ORDER BY n DESC, CASE WHEN facet = 'size' THEN term::BIGINT END, term) AS rank FROM c)
SELECT lang, facet, term, n, top_ids, rank::INTEGER AS rank FROM o WHERE rank <= CASE facet WHEN 'size' THEN 3 ELSE 10 END""")
def facet_counts(spark, sf):
    """Counts by language of two inner terms with sizes of their own."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source", F.floor(F.length("text") / 1000).alias("size"))
    return search.facets(d, "lang", {"source": 10, "size": 3}, "doc_id")
