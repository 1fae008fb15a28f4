"""Commands end to end on small files."""

from __future__ import annotations

import json

import pytest

from folioforge import cli

from folioforge.config import Database, ObjectStore
from tests.test_documents import NOTICE, PAGE, RCP


def test_commands(spark, tmp_path, capsys):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "N12.htm").write_bytes(PAGE.encode())
    (tmp_path / "html" / "R13.htm").write_bytes(PAGE.encode())
    assert cli.main(["parse-html", at("html"), "-o", at("nodes")]) == 0
    assert {r.doc for r in spark.read.json(at("nodes")).select("doc").collect()} == {"12|N12.htm"}
    (tmp_path / "d.sql").write_bytes("INSERT INTO t (a, b) VALUES (1, 'é'), (2, NULL);".encode("latin-1"))
    assert cli.main(["sql-to-csv", at("d.sql"), "-o", at("csv")]) == 0
    assert [tuple(r) for r in spark.read.csv(at("csv"), header=True).collect()] == [("1", "é"), ("2", None)]
    (tmp_path / "r.jsonl").write_text(json.dumps(RCP) + "\n{bad\n")
    (tmp_path / "n.jsonl").write_text(json.dumps(NOTICE))
    (tmp_path / "truth.csv").write_text("CIS,A,B,C\n1,oui,non,non\n9,non,non,oui\n")
    assert cli.main(["classify", "--input", at("r.jsonl"), "--truth", at("truth.csv"), "-o", at("pred")]) == 0
    rows = {r.cis: r for r in spark.read.csv(at("pred"), header=True).collect()}
    assert rows["1"].label_a == "1" and rows["9"].label_a is None and "exact: 1 of 1" in capsys.readouterr().out
    assert cli.main(["index", "sections", "--input", at("r.jsonl"), "-o", at("sections")]) == 0
    assert spark.read.parquet(at("sections")).count() == 2
    assert cli.main(["index", "chunks", "--input", at("n.jsonl"), "-o", at("chunks")]) == 0
    assert len(spark.read.parquet(at("chunks")).first().embedding) == 1024
    assert cli.main(["index", "chunks", "--input", at("n.jsonl"), "--save-embeddings", at("cache"), "-o", at("chunks")]) == 0
    assert cli.main(["index", "chunks", "--input", at("n.jsonl"), "--load-embeddings", at("cache"), "-o", at("again")]) == 0
    assert spark.read.parquet(at("again")).filter("not cached").count() == 0
    assert cli.main(["classify", "--input", at("r.jsonl"), "--debug", "--single", "-o", at("pred")]) == 0
    assert spark.read.json(at("pred.debug.jsonl")).first().texts_4_1 == "chez l'enfant\na\nb" and len(list((tmp_path / "pred").glob("*.csv"))) == 1
    assert cli.main(["import-records", "--input", at("r.jsonl"), "-o", at("import")]) == 0 and spark.read.parquet(at("import/main")).first().title == "skip"
    assert cli.main(["parse-staged", at("html"), "--checkpoint", at("state"), "-o", at("staged")]) == 0 and len(list((tmp_path / "staged").glob("parsed_N_*_batch001.jsonl"))) == 1
    spark.createDataFrame([([["1", "n"]], ["s"], ["p"], "A01")], "specialites array<array<string>>, subs_ids array<string>, pathos_codes array<string>, atc5_code string").write.parquet(at("t/groups"))
    for name in ("substances", "pathologies", "labels"):
        spark.createDataFrame([("s", "S")], "code string, label string").write.parquet(at(f"t/{name}"))
    assert cli.main(["specialites", "--tables", at("t"), "-o", at("spec")]) == 0 and spark.read.parquet(at("spec")).first().substances == ["S"]
    assert cli.main(["specialites", "-o", at("spec")]) == 1
    assert cli.main([]) == 1 and cli.main(["index", "chunks", "--input", at("none"), "-o", at("x")]) == 1


def test_settings():
    assert Database.from_env("PG", "postgresql", 5432, {"PG_URL": "postgres://u:p@h:1/d"}) == Database("jdbc:postgresql://h:1/d", "u", "p")
    assert Database.from_env("PG", "postgresql", 5432, {"PG_HOST": "h", "PG_DATABASE": "d"}).options("t") == {"url": "jdbc:postgresql://h:5432/d", "dbtable": "t"}
    assert Database.from_env("PG", "postgresql", 5432, {}) is None
    store = ObjectStore.from_env(env={"S3_BUCKET": "b", "S3_ENDPOINT": "https://e", "S3_KEY_ID": "k"})
    assert store.path("/a/", "", "x.htm") == "s3a://b/a/x.htm"
    assert store.settings() == {"spark.hadoop.fs.s3a.bucket.b.endpoint": "https://e", "spark.hadoop.fs.s3a.bucket.b.access.key": "k", "spark.hadoop.fs.s3a.bucket.b.path.style.access": "true"}
    with pytest.raises(ValueError):
        ObjectStore.from_env(env={})
