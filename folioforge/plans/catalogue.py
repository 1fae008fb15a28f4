"""Registered queries over the provided tables, with their SQL counterparts.

The provided tables hold no leaflets, so operators run on these tables directly or on texts
that both sides build with the same expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.config import scratch
from folioforge.functions import text as tx
from folioforge.operators import evaluate, labels, load, search
from folioforge.sources import html as html_source
from folioforge.sources import jsonl, sqldump

FLAGSHIP = "confusion_metrics"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- sources and filters


@_query("""SELECT page_id, list_extract(string_split(url, '/'), -1) AS filename FROM pages
WHERE starts_with(list_extract(string_split(url, '/'), -1), '1') AND regexp_matches(list_extract(string_split(url, '/'), -1), '\\.html?$')""")
def scan_filter_files(spark, sf):
    name = tx.basename(F.col("url"))
    return _t(spark, sf, "pages").select("page_id", name.alias("filename")).filter(F.col("filename").startswith("1") & F.col("filename").rlike(r"\.html?$"))


@_query("""WITH n AS (SELECT event_id, 'parsed_N_' || CASE WHEN event_id % 7 = 0 THEN 'undated' ELSE strftime(ts, '%Y%m%d') END || '_batch001.jsonl' AS name,
CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS d FROM events)
SELECT event_id, name FROM n WHERE coalesce(d >= DATE '2024-01-15', true)""")
def since_fail_open(spark, sf):
    day = F.when(F.col("event_id") % 7 == 0, "undated").otherwise(F.date_format("ts", "yyyyMMdd"))
    names = _t(spark, sf, "events").select("event_id", F.concat(F.lit("parsed_N_"), day, F.lit("_batch001.jsonl")).alias("name"))
    return jsonl.parsed_files(names, "name", "2024-01-15")


@_query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_anti(spark, sf):
    return evaluate.missing(_t(spark, sf, "documents").select("doc_id", "lang"), _t(spark, sf, "labels"), "doc_id")


@_query("""SELECT l_orderkey, arg_max(p_name, l_linenumber::BIGINT * 1000000000 + l_partkey) AS p_name, max(l_linenumber) AS l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def filename_map_last_wins(spark, sf):
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(_t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    return evaluate.last_wins(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"]).select("l_orderkey", "p_name", "l_linenumber")


@_query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation")
def sql_dump_rows(spark, sf):
    quoted = F.concat(F.lit("("), F.col("n_nationkey").cast("string"), F.lit(", N'"), F.replace("n_name", F.lit("'"), F.lit("''")), F.lit("', "), F.col("n_regionkey").cast("string"), F.lit(")"))
    dump = _t(spark, sf, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("PRINT 'x';\nINSERT INTO [dbo].[nation] ([n_nationkey], [n_name], [n_regionkey]) VALUES "), F.array_join(F.array_sort(F.collect_list(quoted)), ", "), F.lit(";\n")).alias("value"))
    return sqldump.as_columns(sqldump.insert_rows(dump), ["n_nationkey", "n_name", "n_regionkey"])


# ------------------------------------------------------------------ scalar functions


@_query("""SELECT doc_id, md5(replace(replace(translate('a’b‘c‑d–e≥f≤' || text, '’‘‑–', '''''--'), '≥', '>='), '≤', '<=')) AS h FROM documents""")
def normalise_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.md5(tx.normalise_text(F.concat(F.lit("a’b‘c‑d–e≥f≤"), "text")).cast("binary")).alias("h"))


@_query("""SELECT doc_id, md5(translate(text, '0123456789abcdefghijklmnoprstuvwxyzABDEGHIJKLMNOPRTUVW+-=()', '⁰¹²³⁴⁵⁶⁷⁸⁹ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻᴬᴮᴰᴱᴳᴴᴵᴶᴷᴸᴹᴺᴼᴾᴿᵀᵁⱽᵂ⁺⁻⁼⁽⁾')) AS sup,
md5(translate(text, '0123456789aehijklmnoprstuvx+-=()', '₀₁₂₃₄₅₆₇₈₉ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓ₊₋₌₍₎')) AS sub FROM documents""")
def sup_sub(spark, sf):
    text = F.col("text")
    return _t(spark, sf, "documents").select("doc_id", F.md5(tx.superscript(text).cast("binary")).alias("sup"), F.md5(tx.subscript(text).cast("binary")).alias("sub"))


@_query("""SELECT doc_id, md5(regexp_replace('<p>' || text || '<img alt="x" src="../images/i' || doc_id || '.png"></p>', '<img([^>]*?)src="\\.\\./images/([^"]+)"([^>]*?)(?:\\s*/)?>', '<img\\1src="https://cdn.example.org/images/\\2"\\3 />', 'gi')) AS h FROM documents""")
def rewrite_img(spark, sf):
    html = F.concat(F.lit("<p>"), "text", F.lit('<img alt="x" src="../images/i'), F.col("doc_id").cast("string"), F.lit('.png"></p>'))
    return _t(spark, sf, "documents").select("doc_id", F.md5(tx.rewrite_images(html).cast("binary")).alias("h"))


@_query("SELECT doc_id, md5('<b>' || text || '</b>') AS h FROM documents")
def clean_anchor_html(spark, sf):
    html = F.concat(F.lit('<b><a name="x">'), "text", F.lit("</a></b>"))
    return _t(spark, sf, "documents").select("doc_id", F.md5(tx.unanchor(html).cast("binary")).alias("h"))


@_query("""SELECT p_partkey, array_to_string([left(p_brand, n) FOR n IN [1, 3, 4, 5, 7] IF n <= length(p_brand)], ',') AS codes FROM part""")
def atc_ancestors(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", F.array_join(tx.code_ancestors(F.col("p_brand")), ",").alias("codes"))


@_query("""SELECT count(*) AS n, sum(CASE WHEN try_cast(l_quantity::VARCHAR AS DOUBLE) IS NULL THEN 1 ELSE 0 END)::BIGINT AS bad, round(sum(l_quantity), 2) AS q FROM lineitem""")
def cast_load(spark, sf):
    text = _t(spark, sf, "lineitem").select(F.col("l_quantity").cast("string").alias("l_quantity"))
    good, bad = load.typed(text, {"l_quantity": "double"})
    return good.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("q")).crossJoin(bad.agg(F.count("*").alias("bad"))).select("n", "bad", "q")


# ------------------------------------------------------------------ windows and trees

_LINES_SQL = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"""


def _lines(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@_query("SELECT conv_id || '_' || role AS id, max(turn) AS turn, md5(arg_max(text, turn)) AS h FROM conversations GROUP BY 1")
def section_docs_dedupe(spark, sf):
    c = _t(spark, sf, "conversations").select(F.concat_ws("_", F.col("conv_id").cast("string"), "role").alias("id"), "turn", "text")
    return evaluate.last_wins(c, ["id"], ["turn"]).select("id", "turn", F.md5(F.col("text").cast("binary")).alias("h"))


@_query("WITH " + _LINES_SQL + """, n AS (SELECT doc_id, printf('%06d', pos - pos % 5) AS head, printf('%06d', pos) AS node, pos FROM lines)
SELECT doc_id, head AS node_id, coalesce(string_agg(CASE WHEN node <> head THEN node END, ',' ORDER BY pos), '') AS children FROM n GROUP BY doc_id, head""")
def tree_nodes_ids(spark, sf):
    n = _lines(spark, sf).select("doc_id", "pos", F.format_string("%06d", "pos").alias("node_id"), F.when(F.col("pos") % 5 != 0, F.format_string("%06d", F.col("pos") - F.col("pos") % 5)).alias("parent_id"))
    heads = load.with_children(n).filter("parent_id is null")
    return heads.select("doc_id", "node_id", F.coalesce(F.array_join("children", ","), F.lit("")).alias("children"))


@_query("SELECT conv_id, md5(string_agg(text, ' ' ORDER BY turn)) AS h FROM conversations GROUP BY conv_id")
def recursive_text(spark, sf):
    """Nested JSON built per conversation (each turn below the one before), flattened and read back in order."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    docs = _t(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    leaf = lambda t: F.concat(F.lit('{"type":"b","content":'), F.substring(F.to_json(F.array(t)), 2, 1 << 30), F.lit(""))
    nested = F.aggregate("t", F.lit(""), lambda s, t: F.concat(s, F.rtrim(leaf(t), F.lit("]")), F.lit(',"children":[')))
    line = F.concat(F.lit('{"source":{"cis":"'), F.col("conv_id").cast("string"), F.lit('"},"content":['), nested, F.expr("repeat(']}', size(t))"), F.lit("]}"))
    n = jsonl.nodes(docs.select(line.alias("value")))
    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("path", "content"))), lambda x: x["content"])), " ")
    return n.groupBy(F.col("cis").cast("long").alias("conv_id")).agg(F.md5(text.cast("binary")).alias("h"))


@_query("SELECT page_id, len(regexp_extract_all(html, '<p[\\s>]'))::INTEGER AS paragraphs, len(regexp_extract_all(html, ' class=\"'))::INTEGER AS classed FROM pages")
def pages_blocks(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "html")
    nodes = html_source.html_nodes(pages, "page_id").groupBy("page_id").agg(F.count("*").cast("int").alias("classed"))
    return pages.select("page_id", html_source.paragraphs(F.col("html")).alias("paragraphs")).join(nodes, "page_id", "left").select("page_id", "paragraphs", F.coalesce("classed", F.lit(0)).alias("classed"))


# ------------------------------------------------------------------------- rules

_WORDS = ("que", "pour", "mention", "tion", "zz")
_RULES = labels.Rules(keywords=_WORDS, ages=(r"[0-9]+ ?[a-z]+",), negatives=("ment", "eau", "ing"), adult=("ver",), tie_break={"AB": "AB", "AC": "AC", "BC": "B", "ABC": "AB"})
#: From p (doc_id, lower-cased main texts m, contra texts x, the joined main ones j) to r (doc_id, sig, final).
LABELS_TAIL = """k AS (SELECT *, [s FOR s IN m IF regexp_matches(s, 'que|pour|mention|tion|zz|[0-9]+ ?[a-z]+')] AS km, [s FOR s IN x IF regexp_matches(s, 'que|pour|mention|tion|zz|[0-9]+ ?[a-z]+')] AS kx FROM p),
f AS (SELECT doc_id, len([s FOR s IN km IF NOT regexp_matches(s, 'ment|eau|ing')]) > 0 AS a0, len(kx) > 0 AS b0,
len([s FOR s IN km IF regexp_matches(s, 'ment|eau|ing')]) > 0 OR len(km) = 0 OR contains(j, 'ver') AS c0 FROM k),
s AS (SELECT doc_id, CASE WHEN a0 THEN 'A' ELSE '' END || CASE WHEN b0 THEN 'B' ELSE '' END || CASE WHEN c0 THEN 'C' ELSE '' END AS sig FROM f),
r AS (SELECT doc_id, sig, CASE sig WHEN 'BC' THEN 'B' WHEN 'ABC' THEN 'AB' ELSE sig END AS final FROM s)"""
_KW_SQL = "list_distinct(list_concat([k FOR k IN ['que', 'pour', 'mention', 'tion', 'zz'] IF contains(low, k)], regexp_extract_all(low, '[0-9]+ ?[a-z]+')))"


@_query(f"WITH d AS (SELECT doc_id, lower(text) AS low FROM documents) SELECT doc_id, array_to_string(list_sort({_KW_SQL}), '|') AS keywords FROM d")
def keyword_scan(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(labels.find_keywords(F.col("text"), _RULES)), "|").alias("keywords"))


@_query("SELECT doc_id, CASE WHEN contains(lower(text), 'ment') THEN 'ment' WHEN contains(lower(text), 'eau') THEN 'eau' WHEN contains(lower(text), 'ing') THEN 'ing' END AS negative FROM documents")
def negative_first(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", labels.first_negative(F.col("text"), _RULES).alias("negative"))


#: Every line of a text: the third of each three is contra, the others are main.
_LABEL_SQL = """t AS (SELECT doc_id, string_split(lower(text), chr(10)) AS a FROM documents),
p AS (SELECT doc_id, [s FOR s, i IN a IF i % 3 <> 0] AS m, [s FOR s, i IN a IF i % 3 = 0] AS x, array_to_string([s FOR s, i IN a IF i % 3 <> 0], ' ') AS j FROM t),
""" + LABELS_TAIL


def _labelled(spark, sf):
    lines = F.split("text", "\n")
    main, contra = F.filter(lines, lambda _, i: i % 3 != 2), F.filter(lines, lambda _, i: i % 3 == 2)
    docs = _t(spark, sf, "documents").select("doc_id", main.alias("texts_main"), contra.alias("texts_contra"), F.lit(None).cast("string").alias("code"))
    return labels.classify(docs, rules=_RULES)


@_query("WITH " + _LABEL_SQL + " SELECT doc_id, contains(final, 'A') AS label_a, contains(final, 'B') AS label_b, contains(final, 'C') AS label_c FROM r")
def label_rules(spark, sf):
    return _labelled(spark, sf).select("doc_id", "label_a", "label_b", "label_c")


@_query("WITH " + _LABEL_SQL + " SELECT sig, final, count(*) AS n FROM r GROUP BY sig, final")
def tie_break(spark, sf):
    sig = F.concat(*[F.when(F.size(f"reasons_{x}") > 0, x.upper()).otherwise("") for x in "abc"])
    return _labelled(spark, sf).select(sig.alias("sig"), labels.break_tie(sig, _RULES).alias("final")).groupBy("sig", "final").agg(F.count("*").alias("n"))


_PAIR_SQL = "WITH " + _LABEL_SQL + """, q AS (SELECT contains(final, 'A') AS pa, quality = 1 AS ta, contains(final, 'C') AS pc, toxic = 1 AS tc FROM r JOIN labels USING (doc_id)),
u AS (SELECT 'a' AS label, pa AS p, ta AS t FROM q UNION ALL SELECT 'c', pc, tc FROM q), """


def _pairs(spark, sf):
    truth = _t(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("true_a"), (F.col("toxic") == 1).alias("true_c"))
    return _labelled(spark, sf).select("doc_id", F.col("label_a").alias("pred_a"), F.col("label_c").alias("pred_c")).join(truth, "doc_id")


@_query(_PAIR_SQL + """c AS (SELECT label, count(*) FILTER (p AND t) AS tp, count(*) FILTER (p AND NOT t) AS fp, count(*) FILTER (NOT p AND t) AS fn, count(*) FILTER (NOT p AND NOT t) AS tn FROM u GROUP BY label)
SELECT label, tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy FROM c""")
def confusion_metrics(spark, sf):
    m = evaluate.confusion(_pairs(spark, sf), ["a", "c"])
    return m.select("label", "tp", "fp", "fn", "tn", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "accuracy")])


@_query(_PAIR_SQL + "c AS (SELECT count(*) AS total, count(*) FILTER (pa = ta AND pc = tc) AS exact FROM q) SELECT total, exact, round(exact / total, 6) AS rate FROM c")
def exact_match(spark, sf):
    return evaluate.exact_match(_pairs(spark, sf), ["a", "c"]).withColumn("rate", F.round("rate", 6))


@_query("WITH " + _LABEL_SQL + """, l AS (SELECT doc_id, quality::VARCHAR AS truth FROM labels)
SELECT r.doc_id, contains(final, 'A')::INTEGER AS label_a, truth, 'found' AS state FROM r LEFT JOIN l USING (doc_id)
UNION ALL SELECT doc_id, NULL, truth, 'missing' FROM l WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def prediction_report(spark, sf):
    truth = _t(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("truth"))
    return evaluate.with_truth(_labelled(spark, sf).select("doc_id", F.col("label_a").cast("int").alias("label_a")), truth, "doc_id")


# ----------------------------------------------------- lookups, search, loads, counts


@_query("""SELECT o_orderkey, coalesce(string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey), '') AS names FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY o_orderkey""")
def enrich_docs(spark, sf):
    lines = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    groups = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(lines.alias("ids"))
    docs = _t(spark, sf, "orders").select("o_orderkey").join(groups, "o_orderkey", "left")
    parts = _t(spark, sf, "part").select("p_partkey", "p_name")
    return load.lookup_all(docs, "o_orderkey", "ids", parts, "p_partkey", "p_name", "names").select("o_orderkey", F.array_join("names", "|").alias("names"))


@_query("""WITH u AS (SELECT n_nationkey AS code, n_name AS label FROM nation UNION ALL SELECT r_regionkey, r_name FROM region UNION ALL SELECT s_nationkey, s_name FROM supplier)
SELECT code, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM u WHERE code IS NOT NULL AND label IS NOT NULL GROUP BY code""")
def label_sets_union(spark, sf):
    pick = lambda t, k, v: _t(spark, sf, t).select(F.col(k).alias("code"), F.col(v).alias("label"))
    sets = load.label_sets(pick("nation", "n_nationkey", "n_name"), pick("region", "r_regionkey", "r_name"), pick("supplier", "s_nationkey", "s_name"))
    return sets.select("code", F.array_join("labels", "|").alias("labels"))


@_query("""WITH k AS (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents),
c AS (SELECT lang, source, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (r <= 5) AS top_ids FROM k GROUP BY lang, source),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS rank FROM c) SELECT lang, source, n, top_ids, rank::INTEGER AS rank FROM o WHERE rank <= 10""")
def terms_top_hits(spark, sf):
    return search.terms(_t(spark, sf, "documents"), "lang", "source", 10, "doc_id").select("lang", "source", "n", "top_ids", "rank")


@_query("""WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) SELECT query_id, vec_id, score, rank FROM r WHERE rank <= 5""")
def knn_top5(spark, sf):
    v = _t(spark, sf, "embeddings")
    return search.nearest_all(v, v.filter("vec_id % 100 = 0"))


@_query("""WITH n AS (SELECT doc_id % 100 AS key, doc_id::VARCHAR AS id, md5(text) AS h FROM documents), o AS (SELECT key, id, CASE WHEN key % 10 = 3 THEN 'x' ELSE h END AS g FROM n WHERE NOT (key % 10 = 7 AND id::BIGINT < 200)),
b AS (SELECT coalesce(n.key, o.key) AS key, h, g FROM n FULL JOIN o ON n.key = o.key AND n.id = o.id) SELECT key, bool_and(coalesce(h = g, false)) AND count(h) > 0 AS valid FROM b GROUP BY key""")
def cache_validity(spark, sf):
    now = _t(spark, sf, "documents").select((F.col("doc_id") % 100).alias("key"), F.col("doc_id").cast("string").alias("id"), F.md5(F.col("text").cast("binary")).alias("content_hash"))
    old = now.filter("not (key % 10 = 7 and cast(id as long) < 200)").withColumn("content_hash", F.when(F.col("key") % 10 == 3, "x").otherwise(F.col("content_hash")))
    return search.cache_hits(now, old)


@_query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, 'X', o_totalprice + 1 FROM orders WHERE o_orderkey % 4 = 0""")
def upsert_merge(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter("o_orderkey % 4 = 0").select("o_orderkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq"), "o_totalprice")
    new = new.select("o_orderkey", F.when(F.col("seq") == 1, "X").otherwise("old").alias("o_orderstatus"), (F.col("o_totalprice") + F.col("seq")).alias("o_totalprice"), "seq")
    return load.upsert(o, new, ["o_orderkey"], ["seq"])


@_query(" UNION ALL ".join(f"SELECT '{t}' AS tab, count(*) AS n FROM {t}" for t in TABLES))
def table_counts_union(spark, sf):
    out = None
    for t in TABLES:
        one = _t(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("tab"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@_query("""WITH t AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents), p AS (SELECT term, doc_id, count(*) AS tf FROM t GROUP BY term, doc_id)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY term""")
def posting_counts(spark, sf):
    index = search.postings(_t(spark, sf, "documents"), "doc_id", "text", lambda c: F.split(F.lower(c), " "))
    return index.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@_query("SELECT event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY event_id")
def stream_delta(spark, sf):
    """The events table through a file stream that takes what is there, upserted by key."""
    from folioforge.streaming.incremental import latest, run_available, upsert_into

    at = scratch(spark)
    run_available(spark, sf, _t(spark, sf, "events").schema.simpleString()[7:-1].replace(":", " "), f"{at}/state", upsert_into(f"{at}/out", ["event_id"], ["ts"]), pathGlobFilter="events.parquet")
    return latest(spark, f"{at}/out").select("event_id", "event_type")


from folioforge.plans import leaflets  # noqa: E402, F401  registers its queries
