"""Text functions and label rules on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import labels


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("given,expected", [("l’eau ‘x’ a‑b–c ≥ 3 ≤ 4", "l'eau 'x' a-b-c >= 3 <= 4"), ("", ""), (None, None)])
def test_normalise(spark, given, expected):
    assert one(spark, tx.normalise_text, given) == expected


@pytest.mark.parametrize("given,expected", [
    ('<img src="../images/a.png">', f'<img src="{tx.CDN}a.png" />'),
    ('<img alt="x" src="../images/a.png"/>', f'<img alt="x" src="{tx.CDN}a.png" />'),
    ('<IMG src="../images/a.png">', '<IMG src="../images/a.png">'),
    ('<img src="http://x/a.png">', '<img src="http://x/a.png">'),
    ("no image", "no image"),
])
def test_images(spark, given, expected):
    assert one(spark, tx.rewrite_images, given) == expected


def test_small_functions(spark):
    assert one(spark, tx.superscript, "m2+q") == "ᵐ²⁺q" and one(spark, tx.subscript, "H2O") == "H₂O"
    assert one(spark, tx.unanchor, 'a <a name="x">b\n<b>c</b></a> d') == "a b\n<b>c</b> d"
    assert one(spark, tx.strip_u, " \t x y  \n") == "x y"
    assert one(spark, tx.basename, "a/b/N1.htm") == "N1.htm"
    assert one(spark, tx.code_ancestors, "N02BE01") == ["N", "N02", "N02B", "N02BE", "N02BE01"]
    assert one(spark, tx.code_ancestors, "A01") == ["A", "A01"]
    assert one(spark, tx.analyse_french, "L’enfant et les médicaments chevaux") == ["enfant", "medicament", "cheval"]


def test_bytes(spark):
    df = spark.createDataFrame([(bytearray("é€".encode()),), (bytearray("é€".encode("cp1252")),)], "content binary")
    assert [r[0] for r in df.select(tx.decode_bytes(F.col("content"))).collect()] == ["é€", "é€"]


@pytest.mark.parametrize("text,found", [
    ("Chez l'enfant âgé de moins de 12 ans", ["enfant", "âgé de moins de 12 ans"]),
    ("Les ENFANTS à partir de 16 ans", ["enfant", "enfants", "à partir de 16 ans"]),
    ("poids < 30 kg", ["poids < 30 kg"]),
    ("adulte de 45 ans", []),
])
def test_keywords(spark, text, found):
    assert one(spark, labels.find_keywords, text) == found


def test_negatives_take_the_first_pattern(spark):
    assert one(spark, labels.first_negative, "n'est pas indiqué. Sans objet") == "n'est pas indiquée?"
    assert one(spark, labels.first_negative, "la sécurité et l'efficacité n'ont pas été établies").startswith("sécurité")
    assert one(spark, labels.first_negative, "rien") is None
    assert len(labels.NEGATIVE_PATTERNS) == 25 and len(labels.KEYWORDS) == 19 and len(set(labels.KEYWORDS)) == 19


CASES = [
    (["indiqué chez l'enfant"], [], None, "A"),
    (["chez l'adulte"], [], None, "C"),
    (["ne doit pas être utilisé chez l'enfant"], [], None, "C"),
    (["chez l'enfant"], ["contre-indiqué chez l'enfant"], None, "AB"),
    (["réservé à l'adulte"], ["enfant"], None, "B"),
    (["chez l'enfant"], [], "g03aa07", "AC"),
    (["chez l'enfant", "sans objet chez l'adolescent"], ["nourrisson"], None, "AB"),
    (None, None, None, "C"),
]


def test_labels_reasons_and_ties(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "id int, texts_main array<string>, texts_contra array<string>, code string, expected string")
    for r in labels.classify(df).collect():
        assert "".join(x.upper() for x in "abc" if r[f"label_{x}"]) == r.expected, r
    rows = {r.id: r for r in labels.report_rows(labels.classify(df), "id").collect()}
    assert rows[4].reasons_c and rows[4].label_c == 0  # a reason stays when the tie is broken
    plan = labels.classify(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_strict_rules_ask_for_an_indication(spark):
    df = spark.createDataFrame([(["chez l'enfant"], [], None), (["est indiqué chez l'enfant"], [], None)], "texts_main array<string>, texts_contra array<string>, code string")
    rows = labels.classify(df, rules=labels.Rules(strict=True)).collect()
    assert [(r.label_a, r.label_c) for r in rows] == [(False, True), (True, False)]
    assert [len(r.evidence_main) for r in rows] == [0, 1]


def test_missing_tie_break_entry_leaves_labels(spark):
    assert one(spark, lambda c: labels.break_tie(c, labels.Rules(tie_break={"AC": "C"})), "AB") == "AB"
