"""Queries run over whole texts and tables."""

from __future__ import annotations

from folioforge.plans import catalogue


def write(spark, at, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/{table}.parquet")
    return str(at)


def test_lines_beyond_the_third_are_labelled(spark, tmp_path):
    sf = write(spark, tmp_path, "documents", [(1, "x\nx\nx\npour"), (2, "x\nx\nx\nx\nx\npour"), (3, "pour\nx\nx\nx\never")], "doc_id long, text string")
    got = {r.doc_id: (r.label_a, r.label_b, r.label_c) for r in catalogue.label_rules(spark, sf).collect()}
    assert got == {1: (True, False, False), 2: (False, True, False), 3: (True, False, True)}


def test_superscripts_and_subscripts_cover_the_whole_text(spark, tmp_path):
    from hashlib import md5

    sf = write(spark, tmp_path, "documents", [(1, "Q" * 45 + "2")], "doc_id long, text string")
    row = catalogue.sup_sub(spark, sf).first()
    assert (row.sup, row.sub) == tuple(md5(("Q" * 45 + x).encode()).hexdigest() for x in "²₂")


def test_every_hundredth_vector_is_a_query_across_blocks(spark):
    import numpy as np

    from folioforge.operators import search

    m = np.random.default_rng(4).normal(size=(901, 8))
    m[7] = m[300]  # a tie
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(901, [0.0] * 8), (902, None)], "vec_id long, embedding array<float>").repartition(3)
    got = search.nearest_all(v, v.filter("vec_id % 100 = 0"), block=4).collect()
    m = m.astype(np.float32).astype(float)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    expected = {}
    for q in range(0, 901, 100):
        s = np.round(unit @ unit[q], 6)
        expected |= {(q, r): int(i) for r, i in enumerate(np.lexsort((np.arange(901), -s))[:5], 1)}
    assert {(r.query_id, r["rank"]): r.vec_id for r in got} == expected and len(got) == 50


def test_neighbours_take_one_python_step_and_few_blocks_of_queries(spark):
    from folioforge.operators import search

    # equal vectors, more than k of them and over several blocks, then vectors without a score
    rows = [(i, [1.0, float(i % 3)]) for i in range(600)] + [(i, [0.0, 0.0]) for i in range(600, 640)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(12)
    df = search.nearest_all(v, v.filter("vec_id % 100 = 0"), k=7, block=8)
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got == {q: {n + 1: (q % 3 + 3 * n, 1.0) for n in range(7)} for q in range(0, 600, 100)}
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[-1].count("InArrow") == 1
    assert search._blocks(v.filter("vec_id % 100 = 0").hint("rebalance"), "vec_id", "embedding", 64).count() == 1
    few = search.nearest_all(v.filter("vec_id in (0, 1, 600)"), v.filter("vec_id in (0, 600)"))
    assert sorted((r.query_id, r.vec_id) for r in few.collect()) == [(0, 0), (0, 1)]


def test_report_and_lookup_take_every_row(spark, tmp_path):
    sf = write(spark, tmp_path, "documents", [(3, "pour"), (4, "x")], "doc_id long, text string")
    write(spark, tmp_path, "labels", [(4, 0), (9, 1)], "doc_id long, quality int")
    write(spark, tmp_path, "orders", [(1,), (2,)], "o_orderkey long")
    write(spark, tmp_path, "lineitem", [(1, 7, 1), (1, 8, 2), (1, 5, 3)], "l_orderkey long, l_partkey long, l_linenumber int")
    write(spark, tmp_path, "part", [(7, "odd"), (8, "even")], "p_partkey long, p_name string")
    got = {(r.doc_id, r.label_a, r.truth, r.state) for r in catalogue.prediction_report(spark, sf).collect()}
    assert got == {(3, 1, None, "found"), (4, 0, "0", "found"), (9, None, "1", "missing")}
    assert {r.o_orderkey: r.names for r in catalogue.enrich_docs(spark, sf).collect()} == {1: "odd|even", 2: ""}
