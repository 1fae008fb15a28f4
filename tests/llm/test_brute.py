"""Results of registered queries without SQL, against plain versions written from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import lz_fingerprint, mixing, quality, toxicity, url_filter
from folioforge.llm.queries import queries
from tests.llm.conftest import DATA


def rows_of(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet").collect()


def mixed(x):
    """The 64-bit finaliser that spreads hashes."""
    m = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return x ^ x >> 31


# ------------------------------------------------------------------------ op2


def plain_fingerprint(text):
    """All phrases as byte strings, their polynomial hashes spread, the 128 least of 32 bits."""
    seen, phrase = set(), b""
    for c in text.encode():
        phrase += bytes([c])
        if phrase not in seen:
            seen.add(phrase)
            phrase = b""
    hashes = set()
    for p in seen:
        h = 1
        for c in p:
            h = (h * 0x9E3779B1 + c + 1) & ((1 << 61) - 1)
        hashes.add(mixed(h) >> 32)
    return sorted(hashes)[:128]


def plain_likeness(a, b):
    both = sorted({*a, *b})[:128]
    return sum(x in set(a) and x in set(b) for x in both) / len(both) if both else 1.0


def test_op2_equals_a_plain_version(spark):
    docs = sorted(rows_of(spark, "documents"), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in queries()["op2_lz_fingerprints"](spark, DATA).collect()}
    prints = {r.doc_id: plain_fingerprint(r.text or "") for r in docs}
    assert len(got) == len(docs)
    for r, nxt in zip(docs, docs[1:] + docs[:1]):
        text, k = r.text or "", len(r.text or "") // 4
        edited = text[: len(text) - k] + (nxt.text or "")[:k]
        own, of_edited = prints[r.doc_id], plain_fingerprint(edited)
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert g.fingerprint == "".join(f"{x:08x}" for x in own) and g.edited_fingerprint == "".join(f"{x:08x}" for x in of_edited)
        assert (g.near_edited, g.near_next) == pytest.approx((plain_likeness(own, of_edited), plain_likeness(own, prints[nxt.doc_id])))
    assert lz_fingerprint.SIZE == 128


# ------------------------------------------------------------------------ op3


def test_op3_equals_a_plain_version(spark):
    """From each document's hash: targets, blocks, whole passes, the last pass and its partly taken block."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    hashes = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(mixing.SEED), F.col("doc_id").cast("long"), "text")).collect()}
    rows = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.source) for r in docs.collect()]
    order = sorted({s for *_, s in rows}, key=lambda s: (s is None, s))
    sizes = [sum(n for _, n, x in rows if x == s) for s in order]
    share, capped = [(5, 2, 1)[i % 3] for i in range(len(order))], set()
    while True:
        left = sum(sizes) - sum(3 * sizes[i] for i in capped)
        level = left / sum(w for i, w in enumerate(share) if i not in capped)
        over = {i for i, w in enumerate(share) if i not in capped and w * level > 3 * sizes[i]}
        if not over:
            break
        capped |= over
    expect = {}
    for i, s in enumerate(order):
        own = [(d, n) for d, n, x in rows if x == s]
        target = 3.0 * sizes[i] if i in capped else share[i] * level
        passes, blocks = int(target // sizes[i]), max(1, len(own) // mixing.BLOCK_DOCS)
        rest, block_of = round(target) - passes * sizes[i], {d: hashes[d] % blocks for d, _ in own}
        times = {d: passes for d, _ in own}
        for b in sorted(set(block_of.values())):
            inside = sorted((x for x in own if block_of[x[0]] == b), key=lambda x: (hashes[x[0]], x[0]))
            words = sum(n for _, n in inside)
            if rest <= 0:
                break
            if words > rest:
                for (d, _), fits in zip(inside, mixing.nearest_subset([n for _, n in inside], rest)):
                    times[d] += fits
            else:
                for d, _ in inside:
                    times[d] += 1
            rest -= words
        expect |= {d: (n, sizes[i], pytest.approx(target), n * times[d], times[d]) for d, n in own}
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken, len(r.shards)) for r in queries()["op3_mix_sources"](spark, DATA).collect()}
    assert got == expect


# ------------------------------------------------------------------------ op4


def test_op4_equals_a_plain_version(spark):
    """Word and pair counts of all and of good texts, log ratios, noise, the greatest sums."""
    docs, labels = rows_of(spark, "documents"), rows_of(spark, "labels")
    buckets = quality.BUCKETS

    def grams(text):
        h = [crc32(t) for t in re.findall(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]", (text or "").encode().lower())]
        pairs = [(a * 0x9E3779B97F4A7C15 + b) & ((1 << 64) - 1) for a, b in zip(h, h[1:])]
        return [mixed(x) % buckets for x in (*h, *pairs)]

    of = {r.doc_id: grams(r.text) for r in docs}
    good = {r.doc_id for r in labels if r.quality == 1}
    raw, target = Counter(), Counter()
    for d, g in of.items():
        raw.update(g)
        if d in good:
            target.update(g)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    prior = 50 * n_target / n_raw
    ratio = {b: math.log((target[b] + prior * c / n_raw + 1e-9) / (n_target + prior)) - math.log((c + 1e-9) / n_raw) for b, c in raw.items()}
    got = {r.doc_id: r for r in queries()["op4_quality_resampling"](spark, DATA).collect()}
    key = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.xxhash64(F.lit(quality.SEED), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary"))).collect()}
    draw = {}
    for d, g in of.items():
        weight = sum(ratio[b] for b in g) / max(1, len(g)) ** 0.5
        uniform = ((key[d] % (1 << 64) >> 11) + 0.5) / (1 << 53)
        draw[d] = (weight, weight - math.log(-math.log(uniform)))
    share = len(good) / sum(r.quality in (0, 1) for r in labels)
    best = sorted(draw, key=lambda d: -draw[d][1])[: round(share * len(docs))]
    assert set(got) == set(best)
    for d, r in got.items():
        assert r.n_ngrams == len(of[d]) and (r.log_weight, r.draw) == pytest.approx(draw[d], abs=1e-3)


# ------------------------------------------------------------------------ op6


def plain_trees(rows, trees, depth, rate, penalty):
    """Boosted trees over whole-number features, every split tried on the rows themselves."""
    y = np.array([r["y"] for r in rows], float)
    x = {f: np.array([r[f] for r in rows]) for f in url_filter.FEATURES}
    margin = np.full(len(rows), math.log(y.sum() / (len(y) - y.sum())))
    model = [("bias", margin[0])]

    def grow(at, g, h, depth):
        if not depth:
            return None
        best = (1e-6, None)
        for f in sorted(url_filter.FEATURES):
            for cut in sorted(set(x[f][at].tolist()))[:-1]:
                low = at[x[f][at] <= cut]
                lg, lh, rg, rh = g[low].sum(), h[low].sum(), g[at].sum() - g[low].sum(), h[at].sum() - h[low].sum()
                gain = lg**2 / (lh + penalty) + rg**2 / (rh + penalty) - g[at].sum() ** 2 / (h[at].sum() + penalty)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
        if best[1] is None:
            return ("leaf", rate * g[at].sum() / (h[at].sum() + penalty))
        f, cut = best[1]
        sides = [at[x[f][at] <= cut], at[x[f][at] > cut]]
        kids = [grow(s, g, h, depth - 1) or ("leaf", rate * g[s].sum() / (h[s].sum() + penalty)) for s in sides]
        return ("split", f, cut, *kids)

    def value(tree, row):
        while tree[0] == "split":
            tree = tree[3] if row[tree[1]] <= tree[2] else tree[4]
        return tree[1]

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.round((y - p) * (1 << 20)) / (1 << 20), np.round(p * (1 - p) * (1 << 20)) / (1 << 20)
        tree = grow(np.arange(len(rows)), g, h, depth)
        model.append(tree)
        margin = margin + np.array([value(tree, r) for r in rows])
    return lambda row: model[0][1] + sum(value(t, row) for t in model[1:])


def test_op6_equals_plain_boosting(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url")
    base = url_filter.with_rule(pages.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))}))
    base = url_filter.lexical(base)
    labelled = base.filter("rule is not null").withColumn("y", (F.col("rule_verdict") == "block").cast("int"))
    fit = [r.asDict() for r in url_filter._with_statistics(labelled, labelled).collect()]
    margin = plain_trees(fit, url_filter.TREES, url_filter.DEPTH, url_filter.RATE, url_filter.LAMBDA)
    every = {r.page_id: r.asDict() for r in url_filter._with_statistics(base, labelled).collect()}
    got = {r.page_id: r for r in queries()["op6_url_filter"](spark, DATA).collect()}
    assert set(got) == set(every) and any(r["rule"] is None for r in every.values())
    for k, r in every.items():
        m = margin(r)
        assert got[k].score == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-6)
        if abs(m) > 1e-6:
            assert got[k].verdict == (r["rule_verdict"] or ("block" if m > 0 else "allow"))


# ------------------------------------------------------------------------ op9


def test_op9_scores_equal_a_plain_kernel_sum(spark):
    """Each word's gap-weighted triples added up one by one, over the norm of its length."""
    docs = [r for r in rows_of(spark, "documents") if len(r.text or "") < 3000]
    frames = [spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels")]
    model = toxicity.fit(*frames)
    got = {r.doc_id: r.score for r in queries()["op9_toxicity"](spark, DATA).collect()}
    n_letters, decay, span = toxicity.LETTERS, toxicity.DECAY, toxicity.SPAN

    def margin(word):
        total = norm = 0.0
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + span)):
                for k in range(j + 1, min(len(word), i + span)):
                    w = decay ** (k - i + 1)
                    total += w * float(model.weights[(word[i] * n_letters + word[j]) * n_letters + word[k]])
                    norm += w * w
        return total / math.sqrt(max(norm, 1e-9)) + model.bias

    for r in docs[:60]:
        flat, _ = toxicity.encode([r.text or ""])
        gaps = np.flatnonzero(flat == 0).tolist()
        words = [[0, *flat[a + 1 : b].tolist(), 0] for a, b in zip(gaps, gaps[1:]) if b - a > 1]
        found = sorted(map(margin, words), reverse=True)
        top, second = (found or [model.bias])[0], max([model.bias, *found[1:2]])
        z = model.slope * (top + toxicity.SECOND * second - model.shift)
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-3), r.doc_id
