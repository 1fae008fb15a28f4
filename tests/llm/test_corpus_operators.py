"""op3, op4, op6, op7, op9 and the pipeline: brute force, held-out accuracy, odd input."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import mixing, quality, suffix_dedup, toxicity, url_filter
from folioforge.llm.queries import queries
from tests.llm.conftest import DATA, ODD


def docs_of(spark, sf=DATA):
    return spark.read.parquet(f"{sf}/documents.parquet")


# -------------------------------------------------------------------- mixing


def plain_targets(sizes):
    """By the words of the contract: share by weight, stop at three times, share the excess again."""
    w = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, fixed = [0.0] * len(sizes), set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        left = sum(sizes) - sum(3 * sizes[i] for i in fixed)
        for i in open_:
            target[i] = left * w[i] / sum(w[j] for j in open_)
        over = {i for i in open_ if target[i] > 3 * sizes[i]}
        if not over:
            return [3 * s if i in fixed else target[i] for i, s in enumerate(sizes)]
        fixed |= over


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 1000, 5], [7], [100, 1, 1, 1, 1, 1, 900]])
def test_targets(sizes):
    assert mixing.targets(sizes) == pytest.approx(plain_targets(sizes))


def test_nearest_subset():
    from itertools import chain, combinations

    rng = np.random.default_rng(2)
    for n in range(9):
        sizes = rng.integers(0, 40, n).tolist()
        for goal in (0, 7, 33, 90, 500):
            got = sum(s for s, f in zip(sizes, mixing.nearest_subset(sizes, goal)) if f)
            best = min(abs(goal - sum(c)) for c in chain.from_iterable(combinations(sizes, k) for k in range(n + 1)))
            assert abs(goal - got) == best
    assert sum(mixing.nearest_subset([5] * 1000, 777, tail=10)) in (155, 156)


def test_quotas_are_dealt_exactly():
    q = np.array([100, 7, 0, 3001])
    parts = mixing.split_quotas(q, 7, np.random.default_rng(1))
    assert parts.shape == (7, 4) and (parts.sum(0) == q).all() and (parts >= 0).all()
    assert max(parts.sum(1)) - min(parts.sum(1)) <= 3


def test_mix_meets_its_targets_and_reruns_agree(spark):
    run = lambda: sorted(tuple(r) for r in queries()["op3_mix_sources"](spark, DATA).collect())
    got = run()
    assert got == run()
    by = {r.doc_id: r for r in docs_of(spark).collect()}
    assert len(got) == len(by)
    of = {}
    for doc, size, source_size, target, taken, shards in got:
        assert taken == size * len(shards) and all(0 <= s < mixing.SHARDS for s in shards)
        assert size == len(by[doc].text.split()) and taken <= 3 * size and (not size or taken % size == 0)
        of.setdefault(by[doc].source, []).append((size, source_size, target, taken))
    order = sorted(of)
    assert [of[s][0][2] for s in order] == pytest.approx(plain_targets([sum(x[0] for x in of[s]) for s in order]))
    for rows in of.values():
        assert {r[1] for r in rows} == {sum(r[0] for r in rows)}
        assert abs(sum(r[3] for r in rows) - rows[0][2]) <= 0.05 * rows[0][2]


def test_draws_come_from_the_tree(spark, monkeypatch):
    """With another tree the documents go to other shards; the words that sources give stay."""
    df = docs_of(spark)
    p = mixing.plan(df, block_docs=4)
    blocks = p.documents.groupBy("none", "source", "block").count().count()
    rows = p.draws.collect()
    assert len(rows) == p.n_draws and len({(r.none, r.source, r.block, r["copy"]) for r in rows}) == len(rows)  # disjoint
    assert len({(r.none, r.source, r.block) for r in rows}) <= blocks
    per = np.bincount([r.shard for r in rows], minlength=mixing.SHARDS)
    assert per.max() - per.min() <= 5  # whole quotas, as even as halving allows
    whole = {r.doc_id: (r.taken, r.shards) for r in mixing.mix_report(df).collect()}

    def all_in_one(quotas, shards, rng):
        return np.vstack([quotas, np.zeros((shards - 1, len(quotas)), np.int64)])

    monkeypatch.setattr(mixing, "split_quotas", all_in_one)
    one = {r.doc_id: (r.taken, r.shards) for r in mixing.mix_report(df).collect()}
    assert {s for _, x in one.values() for s in x} == {0} and len({s for _, x in whole.values() for s in x}) > 4
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in whole.items()}
    # a tree that loses draws loses words: nothing but the draws is counted
    monkeypatch.setattr(mixing, "split_quotas", lambda q, n, rng: np.vstack([q, np.zeros((n - 1, len(q)), np.int64)]) * 0)
    with pytest.raises(Exception):
        mixing.mix_report(df).collect()


def test_a_mix_has_no_source_too_many(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 5), f"s{i:05d}") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix_report(df).collect()
    sizes = [r.size for r in sorted(got, key=lambda r: r.doc_id)]
    assert [r.target for r in sorted(got, key=lambda r: r.doc_id)] == pytest.approx(plain_targets(sizes))
    assert all(abs(r.taken - r.target) <= (r.size + 1) / 2 for r in got)  # a source of one document: the nearest multiple


def test_shards_are_shuffled_locally(spark, tmp_path):
    df = spark.createDataFrame([(i, f"w{i} " * 3, "ab"[i % 2]) for i in range(2000)], "doc_id long, text string, source string")
    mixing.mix(df).write.parquet(str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).withColumn("file", F.input_file_name()).collect()
    files = {}
    for r in rows:
        files.setdefault(r.mix_shard, set()).add(r.file)
    assert len(files) == mixing.SHARDS and all(len(x) == 1 for x in files.values())
    first = [r.doc_id for r in rows if r.mix_shard == rows[0].mix_shard]
    assert first != sorted(first) and [r.mix_rank for r in rows if r.mix_shard == 3] == sorted(r.mix_rank for r in rows if r.mix_shard == 3)


def test_mix_rows_agree_with_the_report(spark, make):
    rows = [(i, t, (None, "a", "b")[n % 3]) for n, (i, t) in enumerate(ODD)] + [(100 + i, "w " * (i % 9 + 1), "abc"[i % 3]) for i in range(400)] + [(900, "one two", "a")] * 3
    for df in (make(rows), make(rows).limit(0)):
        report = mixing.mix_report(df).groupBy("doc_id").agg(F.sum("taken").alias("t"), F.sum("size").alias("s")).collect()
        mixed = mixing.mix(df)
        assert mixed.columns == [*(c for c in df.columns if c != "mix_rank"), "mix_copy", "mix_shard", "mix_rank"]
        words = {r[0]: r[1] for r in mixed.select("doc_id", mixing.word_count(F.col("text")).alias("n")).groupBy("doc_id").agg(F.sum("n")).collect()}
        assert {r.doc_id: r.t for r in report if r.t} == {k: v for k, v in words.items() if v}


# ------------------------------------------------------------------- quality


def test_resampling_keeps_good_texts(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.resample(docs_of(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id for r in got.collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good, bad = ([r.doc_id in kept for r in labels if r.quality == k] for k in (1, 0))
    assert len(kept) == round(1000 * np.mean([r.quality for r in labels]))
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_counts_are_those_of_all_texts(spark, make):
    rows = [(1, "a b a"), (2, "b, a"), (3, None), (None, "a"), (2, "b, a")]
    raw, target = quality._counts(make(rows), [2], 64)
    flat = np.concatenate([quality.ngrams((t or "").encode(), 64) for _, t in rows])
    assert (raw == np.bincount(flat, minlength=64)).all()
    assert target.sum() == 2 * len(quality.ngrams(b"b, a", 64))


def test_top_k_is_exact_with_ties(spark):
    rows = [(i, float(i % 5) - 2.25) for i in range(50)] + [(None, 1.75)]
    df = spark.createDataFrame(rows, "doc_id long, draw double")
    for k in (1, 7, 11, 50, 51, 80):
        expect = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0]))[:k]
        assert sorted(map(repr, (tuple(r) for r in quality.top_k(df, k, "draw", "doc_id").collect()))) == sorted(map(repr, expect))


def test_resampling_odd_input(spark, make):
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, None), (None, 1), (5, 0)], "doc_id long, quality int")
    assert 0 < quality.resample(make(ODD), labels).count() < len(ODD)
    assert quality.resample(make(ODD), labels.limit(0), share=0.5).count() == round(len(ODD) / 2)
    assert quality.resample(make(ODD).limit(0), labels).count() == 0


# ---------------------------------------------------------------------- urls


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


URLS = [None, "", "no scheme", "http://", "HTTP://X.EXAMPLE.NET/en/1", "https://example.net/enx?a=1", "ftp://org/fr/", "http://anet/", "http://a.net?x=/", "http://a.net/#://b.org/fr/", "a://b://c.net/", "http://É.example.com/de/\nx", "http://www.example.com/de", "http://x.example.com/de/1" + "?a=b&c=d" * 5000]


def test_hosts_paths_and_rules(spark):
    real = [r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(URLS + real)), "page_id long, url string").withColumns({"host": F.lit(1), "y": F.lit(2), "rule": F.lit(3)})
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    for i, url in enumerate(URLS + real):
        host, path, rule = plain_url(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule[0] if rule else None), url
        assert got[i].verdict == rule[1] if rule else got[i].verdict in ("allow", "block")


def test_trees_tell_urls_of_held_out_hosts(spark):
    """Trained on two thirds of the hosts (there are three domains only), the trees agree with the rules on the others' URLs."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    base = url_filter.with_rule(pages.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))}))
    base = url_filter.lexical(base.filter("rule is not null")).withColumn("y", (F.col("rule_verdict") == "block").cast("int"))
    fold = F.pmod(F.xxhash64("host"), F.lit(3))
    fit, rest = base.filter(fold != 1), base.filter(fold == 1)
    margin = url_filter.train(url_filter._with_statistics(fit, fit))
    m = url_filter._with_statistics(rest, fit).withColumn("right", (margin > 0) == (F.col("y") == 1))
    right, y, n = m.agg(F.avg(F.col("right").cast("int")), F.avg("y"), F.count("*")).first()
    print(f"held-out hosts: {right:.3f} right of {n}, majority {max(y, 1 - y):.3f}")
    assert n > 100 and right > max(y, 1 - y) + 0.02


def test_no_feature_has_the_own_label(spark):
    """Brute force of both statistics; turning a URL's own label round leaves its features as they are."""
    urls = [f"https://{h}/{p}" for h in ("a.net", "x.a.net", "y.a.net", "b.net", "c.org", "x.c.org", "localhost") for p in range(3)]
    df = spark.createDataFrame([(i, u, i % 3 % 2) for i, u in enumerate(urls)], "page_id long, url string, y int")
    df = url_filter.lexical(df.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))}))
    rows = [r.asDict() for r in df.collect()]
    got = {r.page_id: (r.f_suffix, r.f_domain) for r in url_filter._with_statistics(df, df).collect()}
    for r in rows:
        share = lambda some: int((sum(x["y"] for x in some) + 1) / (len(some) + 2) * 16)
        suffix = share([x for x in rows if x["k_suffix"] == r["k_suffix"] and x["k_domain"] != r["k_domain"]])
        assert got[r["page_id"]] == (suffix, share([x for x in rows if x["k_domain"] == r["k_domain"] and x["host"] != r["host"]]))
    turned = df.withColumn("y", F.when(F.col("host") == "a.net", 1 - F.col("y")).otherwise(F.col("y")))
    after = {r.page_id: (r.f_suffix, r.f_domain) for r in url_filter._with_statistics(turned, turned).filter("host = 'a.net'").collect()}
    assert after == {k: got[k] for k in after} and len(after) == 3


def test_urls_degenerate(spark):
    kind = "page_id long, url string"
    one = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.example.org/xx")], kind)
    assert {r.verdict for r in url_filter.judge(one).collect()} == {"block"}
    none = spark.createDataFrame([(2, "http://b.example.org/xx")], kind)
    assert [r.verdict for r in url_filter.judge(none).collect()] == ["allow"]
    assert url_filter.judge(none.limit(0)).count() == 0


# ------------------------------------------------------------------- repeats


def brute_repeats(rows, depth=50):
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    for d, t in order:
        b = (t or "").encode()
        for i in range(len(b) - depth + 1):
            first.setdefault(b[i : i + depth], d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - depth + 1):
            f = first[b[i : i + depth]]
            if f is not None and (d is None or f < d):
                gone[i : i + depth] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((d, len(b), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2] if len(b) else [])).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé "), rng.integers(2, 9)))
    shared = [" ".join(word() for _ in range(n)) for n in (3, 9, 12, 30, 200)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.integers(0, 30))) for _ in range(3)]
        rows.append((int(rng.integers(-5, 50)), parts[0] + shared[rng.integers(5)] + parts[1] + shared[rng.integers(5)][rng.integers(40) :] + parts[2]))
    return rows + [rows[3], (None, rows[5][1]), (7, "ab" * 500), (9, "ab" * 300), (60, "z" * 49), (61, "z" * 50), (62, "z" * 51)]


@pytest.mark.parametrize("block,bucket,many", [(1 << 22, 1 << 22, 8), (700, 5000, 8), (3000, 900, 0)])
def test_repeats_equal_brute_force(make, monkeypatch, block, bucket, many):
    monkeypatch.setattr(suffix_dedup.Block.keys, "__defaults__", (many,))
    rows = passages(block) + ODD
    got = suffix_dedup.repeated_passages(make(rows), block_bytes=block, bucket_bytes=bucket)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_repeats(rows)


def test_suffixes_are_ordered_by_their_bytes():
    """A dictionary's suffixes, judged together, against a plain sort of all of them."""
    import pyarrow as pa

    texts = [(t or "").encode() for _, t in passages(4)]
    block = suffix_dedup.Block(list(range(len(texts))), texts)
    sent = suffix_dedup._send_parts(block, 0, block.parts(np.full(len(block.first), 6, np.uint8), 1))
    got = np.unpackbits(np.frombuffer(suffix_dedup._judge_suffixes(50)(sent).column("codes")[0].as_py(), np.uint8))
    _, entry, start, n = block.parts(np.full(len(block.first), 6, np.uint8), 1)
    raw, doc = block.raw.tobytes(), block.doc[block.first[entry]]
    windows = [(raw[s + i : s + i + 50], int(d)) for s, k, d in zip(start.tolist(), n.tolist(), doc) for i in range(k)]
    least = {}
    for w, d in windows:
        least[w] = min(d, least.get(w, d))
    assert got[: len(windows)].tolist() == [int(d > least[w]) for w, d in windows] and got.any()
    assert int(n.sum()) == int(block.n[block.first].sum()) and isinstance(sent, pa.Table)


def test_pieces_overlap(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 300)
    text = passages(1)[0][1].encode() * 3
    cut = suffix_dedup.Block([1, 2], [text, text[100:]])
    assert int(cut.n.sum()) == 2 * len(text) - 100 - 2 * 49


def test_repeats_of_the_query(spark):
    rows = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    got = sorted((tuple(r) for r in queries()["op7_suffix_array_dedup"](spark, DATA).collect()), key=repr)
    assert got == brute_repeats(rows) and sum(r[2] for r in got) > 0


def test_stripped_texts(make):
    rows = [(2, "start " + "é shared passage of many bytes " * 4 + "end"), (1, "é shared passage of many bytes " * 4), (3, None), (4, "apart")]
    df = make(rows)
    out = suffix_dedup.strip_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[1] == (rows[1][1], len(rows[1][1])) and got[4] == ("apart", 5) and got[3][0] == ""
    assert got[2][0].startswith("start") and got[2][0].endswith("end") and len(got[2][0]) < 20
    assert suffix_dedup.repeats_report(df.limit(0)).count() == 0


# ------------------------------------------------------------------ toxicity

INSULTS = ["grumbold", "snarfle", "blitherpox"]


def sentences(seed, n, toxic):
    rng = np.random.default_rng(seed)
    syl = ["ta", "re", "on", "mi", "lo", "en", "shi", "ga", "dor", "ul"]
    word = lambda: "".join(rng.choice(syl, rng.integers(1, 4)))
    out = []
    for _ in range(n):
        w = [word() for _ in range(rng.integers(8, 40))]
        for _ in range(2 if toxic else 0):
            w.insert(int(rng.integers(len(w))), INSULTS[rng.integers(3)])
        out.append(" ".join(w))
    return out


def test_model_on_held_out_and_disguised_texts():
    model = toxicity.train(sentences(1, 150, True) + sentences(2, 300, False), [1] * 150 + [0] * 300)
    bad, good = model.score(sentences(3, 80, True)), model.score(sentences(4, 400, False))
    assert np.mean(bad >= 0.7) > 0.75 and (bad[:, None] > good[None]).mean() > 0.98 and np.mean(good >= 0.7) < 0.02
    for text in ("you s-n-a-r-f-l-e and s n a r f l e", "grumxbold ta grumbolld re", "GRUMBOLD! Snarfle."):
        assert model.score([text])[0] > np.quantile(good, 0.99)
    odd = model.score(["", "  ", "é", "x" * 100_000, "1234 !!"])
    assert np.isfinite(odd).all() and (odd >= 0).all() and (odd <= 1).all()


def test_folded_weights_are_the_kernel_machine():
    words, marks = ["snarfle", "snarxfle", "tare"], ["snarfle", "tareon"]
    w, u, v = toxicity._kernel_rows(marks)
    dense = np.zeros((toxicity.LETTERS**3, 2), np.float32)
    np.add.at(dense, (u, w), v)
    kernel = toxicity._features(words, dense, np.arange(toxicity.LETTERS**3))
    beta = np.array([1.5, -0.5])
    assert toxicity._word_margins(words, dense @ beta, 0.25) == pytest.approx(kernel @ beta + 0.25, abs=1e-4)
    assert kernel[0, 0] > kernel[1, 0] > kernel[2, 0]


def test_toxicity_query_and_fold(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = docs_of(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    texts, kinds = toxicity.labelled_sample(docs, labels)
    fold = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    assert texts and set(texts) <= fold
    got = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    pos, neg = (np.array([r.score for r in held if r.toxic == k]) for k in (1, 0))
    assert (pos[:, None] > neg[None]).mean() > 0.85
    print(f"held out: recall {np.mean(pos >= 0.7):.3f} of {len(pos)}, false positives {np.mean(neg >= 0.7):.4f} of {len(neg)}")
    assert np.mean(pos >= 0.7) > 0.8 and np.mean(neg >= 0.7) <= 0.01 and all(r.predicted == (r.score >= 0.7) for r in got)


def test_toxicity_odd_input(spark, make):
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, None), (None, 1), (6, 7)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("toxic = 1")):
        rows = toxicity.toxicity_report(make(ODD), lab).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity_report(make(ODD).limit(0), labels).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, tmp_path):
    from folioforge.llm import simhash
    from tests.llm.test_text_operators import brute_contamination

    docs = docs_of(spark)
    names = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        after = docs.collect()
        old = {r.doc_id: r for r in before}
        if name != "mix_sources":
            assert docs.columns == names and len(after) == len({r.doc_id for r in after}) > 0
        if name not in ("mix_sources", "suffix_array_dedup"):
            assert all(tuple(r) == tuple(old[r.doc_id]) for r in after)
        left = spark.read.parquet(f"{DATA}/documents.parquet" if not i else str(tmp_path / str(i - 1)))
        if name == "simhash_near_dedup":
            assert {r.doc_id for r in after} == {r.component_id for r in simhash.near_duplicate_report(left).collect()}
        if name == "suffix_array_dedup":
            assert len(after) == len(before)
            cut = {r[0]: r[2] for r in brute_repeats([(r.doc_id, r.text) for r in before])}
            assert all((len(r.text.encode()) >= len(old[r.doc_id].text.encode()) - cut[r.doc_id] - 6) and (cut[r.doc_id] > 0 or r.text == old[r.doc_id].text) for r in after)
        if name == "benchmark_decontamination":
            bad = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in before], [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]) if r[2]}
            assert bad and {r.doc_id for r in after} == set(old) - bad
        if name == "mix_sources":
            taken = {r.doc_id: r.taken // r.size for r in mixing.mix_report(left).collect() if r.size}
            count = {}
            for r in after:
                count[r.doc_id] = count.get(r.doc_id, 0) + 1
            assert {k: v for k, v in taken.items() if v} == {k: v for k, v in count.items() if k in taken}
