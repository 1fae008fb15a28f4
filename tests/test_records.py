"""Records and pages are walked once, in small batches, without a shuffle."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest

from folioforge.operators import load, search, sections
from folioforge.plans import leaflets
from folioforge.sources import html, jsonl
from tests.test_documents import NOTICE, PAGE, RCP

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def walks(df) -> int:
    """Python nodes of a plan; those of a shuffle that is used again count twice."""
    return plan(df).split("\n\n")[0].count("InArrow") + plan(df).count("ArrowEvalPython")


@pytest.fixture
def both(spark):
    """The same records as lines and as flat nodes."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in (RCP, NOTICE)], "value string")
    return jsonl.records(lines), jsonl.nodes(lines)


def same(spark, both, run):
    a, b = ([sorted(map(str, df.collect())) for df in run(x)] for x in both)
    assert a == b and any(a)


def test_chunks_walk_a_record_once(spark, both):
    same(spark, both, lambda n: [sections.notice_chunks(n)])
    for name in ("chunk_ids", "flat_chunks"):
        df = getattr(leaflets, name)(spark, SF)
        assert walks(df) == 1 and "Exchange" not in plan(df)


def test_embedding_cache_walks_records_once(spark):
    df = leaflets.embedding_cache(spark, SF)
    assert walks(df) == 1  # the stale keys' chunks are embedded; the chunks themselves are stored


def test_embedder_gives_what_single_words_add_up_to():
    got = search.hashing_embedder(["a b a", "", "w" * 99], 16)
    one = lambda w: search.hashing_embedder([w], 16)[0]
    sum_ = 2 * one("a") + one("b")
    assert np.allclose(got[0], sum_ / np.linalg.norm(sum_)) and not got[1].any() and (got[2] == one("w" * 99)).all()


def test_section_documents_walk_a_record_once(spark, both):
    names = spark.createDataFrame([("1", "Name")], "cis string, name string")
    for kind in ("rcp", "notice"):
        same(spark, both, lambda n, kind=kind: [sections.section_docs(n, names, kind)])
    for name in ("section_docs_rcp", "carry_forward"):
        assert walks(getattr(leaflets, name)(spark, SF)) == 1


def test_section_texts_walk_a_record_once(spark, both):
    same(spark, both, lambda n: [sections.texts_of_sections(n, {"4.1": "a", "4.3": "b", "9": "c"})])
    for name in ("first_match_section", "classified_records"):
        assert walks(getattr(leaflets, name)(spark, SF)) == 1


def test_imports_walk_a_record_once(spark, both):
    same(spark, both, load.import_rows)
    assert walks(leaflets.import_main(spark, SF)) == 1
    df = leaflets.import_content(spark, SF)
    assert walks(df) == 1 and "Exchange" not in plan(df)


def test_pages_are_walked_once(spark):
    df = spark.createDataFrame([("d", PAGE), ("e", None)], "doc string, html string")
    same(spark, (df, html.parsed_pages(df, "doc")), lambda x: [html.html_nodes(x, "doc")])
    for name in ("section_tree", "bullet_runs"):
        df = getattr(leaflets, name)(spark, SF)
        assert walks(df) == 1 and "Exchange" not in plan(df) and "Window" not in plan(df)


def test_rows_leave_a_worker_in_small_batches():
    kinds = pa.schema([("x", pa.string())])
    assert [b.num_rows for b in jsonl.batches(iter([("x" * 1_000_000,)] * 12), kinds)] == [5, 5, 2]
    assert [b.num_rows for b in jsonl.batches(iter([("x",)] * 10_000), kinds)] == [4096, 4096, 1808]


def test_reference_documents_read_their_groups_twice(spark):
    text = plan(leaflets.specialite_docs(spark, SF)).split("Initial Plan")[-1]
    assert text.count("lineitem.parquet") <= 3  # for the lists, for the entries and, without their lists, for the codes
