"""Parsers, trees, sections, chunks, loads, search, incremental runs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from folioforge.operators import evaluate, load, search, sections
from folioforge.sources import datasets, html, jsonl, sqldump
from folioforge.streaming import incremental

PAGE = """<html><body><p class="AmmAnnexeTitre2">lost</p><p class="DateNotif">ANSM - 01/02/2024</p>
<p class="AmmNoticeTitre1"><a name="Ann3bDenomination">D’un</a></p><p class="AmmCorpsTexte">x<sup>2</sup> and H<sub>2</sub>O <b>bold</b><img src="../images/a.png"></p>
<p class="AmmListePuces1">one</p><p class="AmmListePuces1">two</p><p class="AmmListePuces1"></p><p class="AmmListePuces2">three</p>
<p class="AmmAnnexeTitre2"><a name="_Toc1">4.1. Sub</a></p><p class="AmmCorpsTexteGras">strong</p>
<table class="AmmCorpsTexteTable"><thead><tr><th class="AmmCorpsTexte">h</th></tr></thead><tbody><tr><td><p class="AmmCorpsTexte">c1</p></td><td><p><u>c2</u></p></td></tr></tbody></table>
<script class="z">no()</script></body></html>"""


def test_html_to_nodes(spark):
    df = spark.createDataFrame([("d", PAGE), ("e", None), ("f", "<p class='a'>unclosed <span class='gras'>b")], "doc string, html string")
    rows = html.html_nodes(df, "doc").orderBy("doc", "node_pos").collect()
    own = [r for r in rows if r.doc == "d"]
    assert [r.type for r in own] == ["DateNotif", "AmmNoticeTitre1", "AmmCorpsTexte", "listePuce", "listePuce", "AmmAnnexeTitre2", "AmmCorpsTexteGras", "table", "z"]
    title, body, bullets, sub, strong, table = own[1], own[2], own[3], own[5], own[6], own[7]
    assert title.content == ["D'un"] and title.anchor == "Ann3bDenomination" and body.t1_pos == title.node_pos and body.t2_pos is None
    assert body.content == ["x² and H₂O bold"] and body.styles == ["bold"] and "https://" in body.html
    assert bullets.content == ["one", "two"] and own[4].content == ["three"]
    assert sub.t2_pos == sub.node_pos and strong.t2_pos == sub.node_pos and strong.styles == ["bold"]
    assert [(c.part, c.text) for c in table.cells] == [("thead", "h"), ("tbody", "c1"), ("tbody", "c2")]
    assert table.cells[1].children == [] and table.cells[2].children[0].styles == ["underline"]
    assert own[8].content == [""] and [r.type for r in rows if r.doc == "f"] == ["a", "gras"]


def block(kind, content, *children, anchor=None):
    return {k: v for k, v in {"type": kind, "content": content, "anchor": anchor, "children": list(children)}.items() if v is not None}


RCP = {"source": {"cis": "1", "filename": "R1"}, "content": [
    block("AmmAnnexeTitre", "skip"), block("DateNotif", "01/01/2024"),
    block("AmmAnnexeTitre1", "4. Clinique", block("AmmAnnexeTitre2", "4.1. Indications", block("AmmCorpsTexte", " chez l'enfant "), block("AmmAnnexeTitre3", "Posologie"), block("listePuce", ["a", " ", "b"]), anchor="_Toc1"),
          block("AmmAnnexeTitre2", "4.3 Contre", block("AmmCorpsTexte", "non"), anchor="RcpContreIndic"), block("AmmCorpsTexte", "loose"))]}
NOTICE = {"source": {"cis": "2"}, "content": [
    block("AmmNoticeTitre1", "Encadré", block("AmmCorpsTexte", "early"), block("AmmCorpsTexteGras", "Head"), block("AmmCorpsTexte", "t1"), {"type": "table", "text": "cells"}, block("AmmCorpsTexteGras", "Alone"), anchor="_x"),
    block("DateNotif", "2024"), block("AmmNoticeTitre1", "6. Emballage", block("AmmCorpsTexte", "box"), anchor="Ann3bEmballage"),
    block("AmmNoticeTitre1", "2. Infos", block("AmmAnnexeTitre2", "Sportifs", block("AmmCorpsTexte", "care"), anchor="_y"), block("AmmCorpsTexte", "orphan"), anchor="_z")]}


@pytest.fixture
def nodes(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text("\n".join([json.dumps(RCP), "", "{broken", json.dumps(NOTICE)]))
    good, bad = jsonl.read_lines(spark, str(tmp_path / "p.jsonl"))
    assert good.count() == 2 and [r.value for r in bad.collect()] == ["{broken"]
    return jsonl.nodes(good)


def test_sections(spark, nodes):
    names = spark.createDataFrame([("1", "Name")], "cis string, name string")
    rcp = {r.section_anchor: r for r in sections.section_docs(nodes.filter("cis = '1'"), names, "rcp").collect()}
    assert set(rcp) == {"RcpIndicTherap", "RcpContreindications"}
    first = rcp["RcpIndicTherap"]
    assert first.id == "1_RcpIndicTherap_rcp" and first.text_content == "4.1. Indications chez l'enfant Posologie a b" and first.date_notif == "01/01/2024" and first.spec_name == "Name"
    notice = {r.section_anchor: r for r in sections.section_docs(nodes.filter("cis = '2'"), names, "notice").collect()}
    assert notice["Ann3bEncadre"].date_notif == "" and notice["Ann3bInfoNecessaires"].date_notif == "2024" and notice["Ann3bEncadre"].spec_name == ""
    assert "cells" not in notice["Ann3bEncadre"].text_content


def test_chunks(nodes):
    got = {(r.section_anchor, r.sub_header): r for r in sections.notice_chunks(nodes.filter("cis = '2'")).collect()}
    assert {k: r.text for k, r in got.items()} == {("Ann3bEncadre", ""): "early", ("Ann3bEncadre", "Head"): "t1", ("Ann3bSportifs", "Sportifs"): "care"}
    assert got[("Ann3bSportifs", "Sportifs")].embed_text == "2. Infos > Sportifs: care"


def test_section_texts(nodes):
    assert sections.texts_of_section(nodes, "4.1", "t").first().t == ["chez l'enfant", "a", "b"]
    assert sections.texts_of_section(nodes, "4.9", "t").count() == 0


@pytest.mark.parametrize("anchor,title,kind,expected", [("_1", "4.1 Titre", "rcp", "RcpDonneesCliniques"), ("_1", "4. Titre", "rcp", "RcpDonneesCliniques"), ("RcpPresentation", "x", "rcp", "RcpNumAutor"), ("_1", "Effets  indésirables", "notice", "Ann3bEffetsIndesirablesDesc"), ("other", "1. A", "notice", "other"), (None, "x", "notice", "")])
def test_anchors(spark, anchor, title, kind, expected):
    df = spark.createDataFrame([(anchor, title)], "a string, t string")
    assert sections.normalise_anchors(df, "a", "t", kind).first().norm_anchor == expected
    assert len(sections.RCP_NUMBERS) == 30 and len(sections.NOTICE_NUMBERS) == 6 and len(sections.NOTICE_TITLES) == 19 and len(sections.ALIASES) == 8


def test_sql_dump(spark):
    dump = "SET x;\nINSERT INTO [dbo].[T] ([a], [b], [c]) VALUES (1, N'it''s, (ok)', NULL), (-2.5, 'x', CAST(1 AS INT));\nUPDATE t SET a = 1;\nINSERT INTO u VALUES ('z');"
    rows = sqldump.insert_rows(spark.createDataFrame([(dump,), (None,)], "value string")).collect()
    assert [(r.stmt, r["row"], r["tab"], list(r.vals)) for r in rows] == [(0, 0, "T", ["1", "it's, (ok)", None]), (0, 1, "T", ["-2.5", "x", "CAST(1 AS INT)"]), (1, 0, "u", ["z"])]
    assert rows[2].cols == ["col0"]


def test_datasets(spark, tmp_path):
    (tmp_path / "c.yml").write_text("datasets:\n- id: d\n  table: t\n  source: {type: csv, url: u, delimiter: ';', encoding: cp1252, quotechar: $}\n  columns: [{name: a, type: str}, {name: b, type: str}]\n- id: e\n  source: {type: csv, delimiter: '|'}\n  columns: [{name: a}, {name: b}]\n")
    known = datasets.catalogue(str(tmp_path / "c.yml"))
    (tmp_path / "d.csv").write_bytes("a;b\n$é;1$;€\nshort\n1;2;3\n$x\ny$;z\nlast;\n".encode("cp1252"))
    good, bad = datasets.read_dataset(spark, known["d"], str(tmp_path / "d.csv"))
    assert [tuple(r) for r in good.collect()] == [("é;1", "€"), ("x\ny", "z"), ("last", None)]
    assert bad.count() == 2 and [r.value for r in bad.collect()] == ["short", "1;2;3"]
    (tmp_path / "e.csv").write_text('a|b\n1|"x\ny"\nshort\n1|2|3\n')
    good, bad = datasets.read_dataset(spark, known["e"], str(tmp_path / "e.csv"))
    assert [tuple(r) for r in good.collect()] == [("1", "x\ny")] and len(bad.collect()) == 2
    (tmp_path / "bad.yml").write_text("- id: x\n  source: {type: xml}\n  columns: []\n")
    with pytest.raises(ValueError):
        datasets.catalogue(str(tmp_path / "bad.yml"))


def test_lists_and_truth(spark):
    lines = spark.createDataFrame([("123, x",), ("abc",), ("123",), ("",)], "value string")
    assert [r.cis for r in datasets.allow_list(lines).collect()] == ["123"]
    truth = datasets.ground_truth(spark.createDataFrame([("1", "g", "oui", "non", " OUI ")], "CIS string, code string, `A:x` string, `B:y` string, `C:z` string"))
    assert tuple(truth.first()) == ("1", True, False, True)
    names = spark.createDataFrame([("parsed_N_20240101_1.jsonl",), ("parsed_N_x_1.jsonl",), ("parsed_N_20250101_1.jsonl",)], "name string")
    assert jsonl.parsed_files(names, "name", "2024-06-01").count() == 2


def test_metrics(spark):
    pairs = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "pred_a boolean, true_a boolean")
    m = evaluate.confusion(pairs, ["a"])
    assert tuple(m.select("tp", "fp", "fn", "tn", "precision", "f1").first()) == (1, 1, 1, 1, 0.5, 0.5)
    none = evaluate.confusion(pairs.filter("not pred_a and not true_a"), ["a"]).first()
    assert none.precision == 0.0 and none.accuracy == 1.0
    assert "exact: 2 of 4" in evaluate.report(m, evaluate.exact_match(pairs, ["a"]))


def test_loads(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, o int")
    once = load.upsert(old, new, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "d"), (3, "e")]
    assert sorted(map(tuple, load.upsert(once, new, ["k"], ["o"]).collect())) == [(1, "a"), (2, "d"), (3, "e")]
    good, bad = load.typed(spark.createDataFrame([("1", "x"), ("y", "z"), (None, "w")], "n string, t string"), {"n": "int"})
    assert good.count() == 2 and [r.n for r in bad.collect()] == ["y"]
    docs = spark.createDataFrame([(1, ["b", "x", "a", "b"]), (2, None)], "k int, ids array<string>")
    table = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, l string")
    assert {r.k: r.out for r in load.lookup_all(docs, "k", "ids", table, "id", "l", "out").collect()} == {1: ["B", "A", "B"], 2: []}
    codes = spark.createDataFrame([(1, "A01")], "k int, c string")
    labels = spark.createDataFrame([("A", "x"), ("A01", "z"), ("A01", "y")], "code string, label string")
    assert load.code_labels(codes, "k", "c", labels).first().code_labels == ["A", "x", "A01", "y", "z"]


def test_search(spark):
    docs = spark.createDataFrame([(1, "le chat noir"), (2, "le chien"), (3, "chat chat blanc")], "id int, t string")
    index = search.postings(docs, "id", "t")
    assert [r.id for r in search.bm25(index, ["chat"], "id").collect()] == [3, 1]
    chunks = docs.select(F.col("t").alias("embed_text"), "id")
    vectors = search.embed(chunks, batch=2)
    query = search.hashing_embedder(["le chien"])[0].tolist()
    assert search.nearest(vectors, query, 1, "id").first().id == 2
    now = spark.createDataFrame([("a", "1", "h"), ("a", "2", "h"), ("b", "1", "h")], "key string, id string, content_hash string")
    old = spark.createDataFrame([("a", "1", "h"), ("b", "1", "h"), ("c", "1", "h")], "key string, id string, content_hash string")
    assert {r.key: r.valid for r in search.cache_hits(now, old).collect()} == {"a": False, "b": True, "c": False}


def test_incremental_run_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    handle = incremental.upsert_into(out, ["k"], ["v"])
    spark.createDataFrame([(1, 1), (2, 1)], "k int, v int").write.parquet(src)
    for _ in range(2):
        incremental.run_available(spark, src, "k int, v int", state, handle)
    spark.createDataFrame([(2, 5), (3, 1)], "k int, v int").write.mode("append").parquet(src)
    incremental.run_available(spark, src, "k int, v int", state, handle)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/v=1").collect())) == [(1, 1), (2, 5), (3, 1)]
