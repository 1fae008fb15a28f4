"""Deep pages, databases, packages, batches, caches and counters."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from folioforge.config import Database, scratch
from folioforge.operators import evaluate, load, search
from folioforge.sources import databases, datasets, html, jsonl
from folioforge.streaming import batches, incremental
from tests.test_documents import NOTICE, PAGE, RCP


def test_deep_pages_and_refused_ones(spark):
    deep = "<b>" * 10_000 + '<p class="a">x</p>'
    unclosed = "".join(f'<p class="c">{i}' for i in range(900))  # every paragraph lies in the one before
    bomb = '<div class="c">' * 20_000 + "x"
    df = spark.createDataFrame([("deep", deep), ("unclosed", unclosed), ("bomb", bomb), ("none", None)], "doc string, html string")
    parsed = html.parsed_pages(df, "doc").persist()
    rows = html.html_nodes(parsed, "doc").groupBy("doc").count().collect()
    assert {r.doc: r["count"] for r in rows} == {"deep": 1, "unclosed": 900}
    bad = {r.doc: r.error for r in html.html_rejects(parsed).collect()}
    assert set(bad) == {"bomb"} and "too deeply" in bad["bomb"]
    tree = html.parse(deep).children[0]
    assert tree.text() == "x" and tree.html().startswith("<b><b>") and sum(1 for _ in tree.walk()) == 10_000
    parsed.unpersist()


@pytest.fixture
def derby(tmp_path):
    return Database(f"jdbc:derby:memory:{tmp_path.name};create=true")


def test_databases(spark, derby, tmp_path):
    spark.sparkContext.setCheckpointDir(scratch(spark))
    databases.replace(spark.createDataFrame([(1, 11, ), (2, 12), (3, 12)], "DocId int, SpecId int"), derby, "Spec_Doc")
    databases.replace(spark.createDataFrame([(1, "a/N1.htm"), (2, "b/N1.htm"), (3, "c/R2.htm")], "DocId int, DocPath string"), derby, "Document")
    read = lambda t: databases.read(spark, derby, t)
    got = databases.filename_map(read("Spec_Doc"), read("Document"))
    assert {tuple(r) for r in got.collect()} == {("N1.htm", "12"), ("R2.htm", "12")}
    spec = spark.createDataFrame([(11, True, "A"), (12, False, "B"), (13, True, "C")], "SpecId int, isBdm boolean, SpecDenom01 string")
    databases.replace(spec, derby, "Specialite")
    plan = databases.authorised(read("Specialite"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "SPECDENOM01" not in plan.upper().split("READSCHEMA")[-1]
    assert {r.cis for r in databases.authorised(read("Specialite")).collect()} == {"11", "13"}
    assert {tuple(r) for r in databases.names(read("Specialite")).collect()} == {("11", "A"), ("13", "C")}
    codes = spark.createDataFrame([(11, "A01"), (11, "B02"), (12, None)], "code_cis int, code_terme_atc string")
    assert {tuple(r) for r in databases.code_map(codes).collect()} == {("11", "B02"), ("12", None)}
    new = spark.createDataFrame([(13, False, "D"), (14, True, "E")], "SpecId int, isBdm boolean, SpecDenom01 string")
    databases.upsert(new, derby, "Specialite", ["SpecId"])
    assert {tuple(r) for r in read("Specialite").collect()} == {(11, True, "A"), (12, False, "B"), (13, False, "D"), (14, True, "E")}
    by = databases.read(spark, derby, "Specialite", ("SpecId", 11, 14, 3))
    assert by.rdd.getNumPartitions() == 3 and by.count() == 4


def test_reference_documents_from_a_database(spark, derby):
    put = lambda name, rows, schema: databases.replace(spark.createDataFrame(rows, schema), derby, name)
    put("resume_substances", [(1, "s1"), (2, "s2")], "NomId int, NomLib string")
    put("resume_pathologies", [(" p ", "P")], "codePatho string, NomPatho string")
    put("atc", [("A", "alpha"), ("A01", None)], "code string, label_court string")
    put("ref_atc_friendly_niveau_1", [("A", "friendly")], "code string, libelle string")
    put("ref_atc_friendly_niveau_2", [("A01", "second")], "code string, libelle string")
    put("resume_medicaments", [("x", "y", "z", "w")], "specialites string, subsIds string, pathosCodes string, atc5Code string")
    tables = databases.reference_tables(spark, derby)
    assert tables["groups"].columns == ["specialites", "subs_ids", "pathos_codes", "atc5_code"]  # arrays need a database that has them
    groups = spark.createDataFrame([([["1", "one"], ["2", "two"]], [" 2", "1", "9", "2"], ["p"], "A01"), ([["3", "three"], []], None, None, None)], "specialites array<array<string>>, subs_ids array<string>, pathos_codes array<string>, atc5_code string")
    got = {r.cis_code: r for r in load.specialite_docs(**(tables | {"groups": groups})).collect()}
    assert set(got) == {"1", "2", "3"} and got["2"].spec_name == "two"
    assert got["1"].substances == ["s2", "s1", "s2"] and got["1"].pathologies == ["P"] and got["1"].atc_labels == ["A", "alpha", "friendly", "A01", "second"]
    assert got["3"].substances == got["3"].pathologies == got["3"].atc_labels == []


def test_packages(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v\n1;x\n2;\n")
    (tmp_path / "datapackage.json").write_text(json.dumps({"resources": [{"name": n, "path": "a.csv", "dialect": {"delimiter": ";"}, "schema": {"fields": [{"name": "k", "type": "integer"}, {"name": "v", "type": "string"}]}} for n in ("one", "two", "left")]}))
    tables = datasets.package(spark, f"{tmp_path}/datapackage.json", ("left",))
    assert set(tables) == {"one", "two"} and [tuple(r) for r in tables["one"].collect()] == [(1, "x"), (2, None)]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS packs LOCATION '{tmp_path}/packs'")
    for _ in range(2):
        datasets.publish(tables, "packs", ("old",))
    assert spark.table("packs.two").count() == 2
    for _ in range(2):
        load.ensure_table(spark, "packs.new", tables["one"])
    assert spark.table("packs.new").columns == ["k", "v"] and spark.table("packs.new").count() == 0
    spark.sql("DROP DATABASE packs CASCADE")


def test_landing(tmp_path):
    (tmp_path / "source").write_bytes(b"a,b\n")
    at = datasets.land(datasets.Dataset("d", "t", f"file://{tmp_path}/source", ("a", "b")), str(tmp_path))
    assert open(at, "rb").read() == b"a,b\n"


def test_staged_batches(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "staging").mkdir()
    for i in range(5):
        (tmp_path / "staging" / f"N{i}.htm").write_bytes(PAGE.encode())
    (tmp_path / "staging" / "R9.htm").write_bytes(PAGE.encode())
    mapping = spark.createDataFrame([(f"N{i}.htm", f"c{i}") for i in range(4)], "filename string, cis string")
    run = lambda: batches.parse_staged(spark, at("staging"), at("out"), at("state"), "N", "20240101_000000", mapping, at("archive"), size=3)
    wrote = run()
    assert len(wrote) == 2 and all("/parsed_N_20240101_000000_batch00" in w for w in wrote)
    docs = {r.doc for w in wrote for r in spark.read.json(w).select("doc").collect()}
    assert docs == {f"c{i}|N{i}.htm" for i in range(4)}
    assert sorted(p.name for p in (tmp_path / "archive").iterdir() if p.suffix == ".htm") == [f"N{i}.htm" for i in range(5)]
    assert [p.name for p in (tmp_path / "staging").iterdir() if p.suffix == ".htm"] == ["R9.htm"] and run() == []
    assert batches.exists(spark, at("archive/N1.htm")) and not batches.exists(spark, at("archive/N8.htm")) and not batches.move(spark, at("no"), at("x"))


def test_imported_records(spark):
    records = [RCP, NOTICE, {"source": {"cis": "x", "filename": "bad"}, "content": [{"type": "b", "content": "t"}]}, {"source": {}, "content": [{"type": "b", "content": "t"}]}]
    odd = {"source": {"cis": "7"}, "content": [{"type": "AmmAnnexeTitre", "content": ["one"]}, {"type": "AmmAnnexeTitre", "content": "two"}, {"type": "c", "text": "no content"}, {"type": "d", "content": "k", "html": "<a name=x>in</a>", "children": [{"type": "e"}, {"type": "f", "text": "cell"}, {"type": "g", "content": ""}]}]}
    main, content, bad = load.import_rows(jsonl.nodes(spark.createDataFrame([(json.dumps(r),) for r in [*records, odd]], "value string")))
    by = {r.code_cis: r for r in main.collect()}
    assert set(by) == {1, 2, 7} and (by[1].title, by[1].date_notif) == ("skip", "01/01/2024") and by[7].title == "two" and by[7].date_notif is None
    assert [r.cis for r in bad.collect()] == ["x"]
    rows = {r.type: r for r in content.filter("code_cis = 7").collect()}
    assert set(rows) == {"d", "f"} and rows["d"].html == "in" and rows["d"].children == [rows["f"].id] and by[7].children == [rows["d"].id]
    again = load.import_rows(jsonl.nodes(spark.createDataFrame([(json.dumps(odd),)], "value string")))[1]
    both = load.replace_trees(content, again, "code_cis")
    assert both.count() == content.count() and both.select("id").distinct().count() == content.count()


def test_embeddings_come_from_a_valid_cache_only(spark, tmp_path):
    calls = str(tmp_path / "calls")
    chunks = spark.createDataFrame([("a", "h1", "1", "x"), ("a", "h1", "2", "y"), ("b", "h2", "3", "z"), ("c", "h3", "4", "w")], "key string, content_hash string, id string, embed_text string")

    def embedder(texts):
        with open(calls, "a") as f:
            f.write("".join(t + "\n" for t in texts))
        return search.hashing_embedder(texts, 4)

    search.save_cache(search.embed_cached(chunks.filter("key <> 'c'"), None, embedder=embedder), str(tmp_path / "cache"), 2)
    open(calls, "w").close()
    now = chunks.withColumn("content_hash", F.when(F.col("key") == "b", "other").otherwise(F.col("content_hash")))
    rows = search.embed_cached(now, spark.read.parquet(str(tmp_path / "cache")), embedder=embedder).collect()
    assert {r.id: r.cached for r in rows} == {"1": True, "2": True, "3": False, "4": False} and all(len(r.embedding) == 4 for r in rows)
    assert set(open(calls).read().split()) == {"z", "w"}
    assert search.embed_cached(now, None, embedder=embedder).filter("cached").count() == 0


def test_calls_are_made_again_after_a_while(spark, tmp_path):
    waits = str(tmp_path / "waits")

    def embedder(texts):
        if not __import__("os").path.exists(waits) or len(open(waits).read().split()) < 3:
            raise TimeoutError
        return search.hashing_embedder(texts, 2)

    def sleep(s):
        with open(waits, "a") as f:
            f.write(f"{s}\n")

    one = spark.createDataFrame([("t",)], "embed_text string").coalesce(1)
    assert search.embed(one, embedder, sleep=sleep).count() == 1 and open(waits).read().split() == ["1", "2", "4"]

    def broken(texts):
        raise KeyError("not again")

    with pytest.raises(Exception, match="not again"):
        search.embed(one, broken, sleep=sleep).collect()


def test_counters_numbers_and_latest(spark, tmp_path):
    df = spark.range(1000).withColumn("odd", F.col("id") % 2 == 1).repartition(7)
    seen = evaluate.Counters(odd="odd")
    got = load.numbered(seen.watch(df), ["id"], 300)
    assert {(r.id, r.batch) for r in got.collect()} == {(i, i // 300) for i in range(1000)}
    seen = evaluate.Counters(odd="odd")
    seen.watch(df).write.format("noop").mode("overwrite").save()
    assert seen.values() == {"rows": 1000, "odd": 500}
    out = str(tmp_path / "o")
    handle = incremental.upsert_into(out, ["id"], ["odd"])
    for n in range(4):
        handle(df.filter(f"id % 4 = {n}"), n)
    assert incremental.latest(spark, out).count() == 1000 and len(list((tmp_path / "o").glob("v=*"))) == 2


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch(Session)
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch(Session)
