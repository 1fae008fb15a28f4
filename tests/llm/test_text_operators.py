"""op1, op2, op5, op8, op10 against brute force and on odd input."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from xxhash import xxh64_intdigest

from folioforge.llm import decontam, license_scan, lz_fingerprint, simhash, token_counts
from folioforge.llm.queries import queries
from tests.llm.conftest import DATA, ODD


def docs_of(spark, sf=DATA):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ------------------------------------------------------------------ licenses


def test_alignment_is_increasing_and_finds_all_of_an_edited_text():
    a = "w x permission is hereby granted free of charge to any one who asks y".split()
    b = "permission is granted free of charge to any person who asks".split()
    pairs = license_scan.align(a, b)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs)
    assert len(pairs) == 10


def test_license_scan_planted(make):
    mit = license_scan.TEMPLATES["MIT"]
    prose = "alpha beta gamma delta the of and to in is that " * 50
    edited = mit.replace("free of charge", "at no cost")
    rows = {r.doc_id: r for r in license_scan.scan(make([(1, prose + mit + prose), (2, prose + edited), (3, prose), (4, prose + "Licensed under CC BY-NC 4.0.\n" + prose), *[(10 + i, t) for i, (_, t) in enumerate(ODD)]])).collect()}
    assert rows[1].license == "MIT" and rows[1].coverage == 1.0
    assert rows[2].license == "MIT" and 0.9 < rows[2].coverage < 1
    assert rows[3].license is None and rows[4].license == "CC-BY-NC-4.0-notice"
    assert all(rows[10 + i].license is None for i in range(len(ODD)))


def test_license_with_foreign_words_between_its_parts(make):
    w = license_scan.TEMPLATES["ISC"].split()
    text = " ".join([*w[:12], *(f"inserted{i}" for i in range(200)), *w[12:]])
    row = license_scan.scan(make([(1, text)])).first()
    assert (row.license, row.coverage, row.start_word, row.end_word) == ("ISC", 1.0, 0, row.n_words)


def test_all_licenses_of_a_text_and_no_resemblance(make):
    t = license_scan.TEMPLATES
    prose = "some words between the two notices " * 30
    rows = [(1, t["MIT"] + prose + t["GPL"] + prose + "Released under the MIT License."), (2, t["LGPL"]), (3, t["AGPL"]), (4, "code released under a license like the MIT one"), (5, "This is not released under the MIT License."), (6, "It isn't licensed under CC BY-NC 4.0."), (7, "Released under MIT license."), (8, t["MPL-2.0"] + t["Unlicense"])]
    got = {r.doc_id: [x.license for x in r.licenses] for r in license_scan.scan(make(rows)).collect()}
    assert sorted(got[1]) == ["GPL", "MIT", "MIT-notice"] and got[2] == ["LGPL"] and got[3] == ["AGPL"]
    assert got[4] == got[5] == got[6] == [] and got[7] == ["MIT-notice"] and sorted(got[8]) == ["MPL-2.0", "Unlicense"]


def brute_common(a, b):
    """Length of the longest common subsequence."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_at_most_and_mostly_the_longest(spark):
    """Against the longest common subsequence: never more, all of it where words are unique, and the scan's matches are real."""
    import random

    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randrange(12))] for _ in range(2))
        assert len(license_scan.align(a, b)) <= brute_common(a, b)
        b = rng.sample(range(40), 20)
        a = [x for x in b if rng.random() < 0.8] + [99]
        assert len(license_scan.align(a, b)) == brute_common(a, b) == len(a) - 1
    by = {r.doc_id: license_scan.words(r.text.encode()) for r in docs_of(spark).collect()}
    hits = [r for r in queries()["op1_license_scan"](spark, DATA).collect() if r.license]
    for r in hits:
        w = license_scan.words(license_scan.TEMPLATES[r.license].encode())
        assert 0.8 <= r.coverage <= brute_common(by[r.doc_id][r.start_word : r.end_word], w) / len(w) and r.matched == round(r.coverage * len(w))
    assert hits


# -------------------------------------------------------------- fingerprints


def brute_phrases(data: bytes) -> set:
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


@pytest.mark.parametrize("text", [b"", b"a", b"abababababab", "é日本 abc abc abc".encode(), bytes(range(256)) * 5])
def test_phrases_are_those_of_the_plain_parse(text):
    p = lz_fingerprint.Parser().feed(text)
    assert len(p.hashes) - 1 == len(brute_phrases(text))
    half = lz_fingerprint.Parser().feed(text[: len(text) // 2])
    assert half.copy().feed(text[len(text) // 2 :]).hashes == p.hashes


def test_edits_and_following_texts(spark, make):
    rows = [(i, t) for i, t in ODD if i is not None]
    got = lz_fingerprint.edit_report(make(rows)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: r[0])
    expect = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 4
        expect.append((i, len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(expect)
    prints = {r.fingerprint for r in got if r.doc_id in (4, 5)}
    assert len(prints) == 1


def test_edited_texts_are_nearer_than_the_next(spark):
    got = queries()["op2_lz_fingerprints"](spark, DATA).collect()
    docs = docs_of(spark).orderBy("doc_id").collect()
    assert len(got) == len(docs)
    assert all(r.near_edited > r.near_next for r in got)
    by = {r.doc_id: r for r in got}
    p = lz_fingerprint
    for a, b in list(zip(docs, docs[1:]))[:40]:
        mine, other = (p.Parser().feed(x.text.encode()).sketch() for x in (a, b))
        assert by[a.doc_id].fingerprint == p.to_string(mine)
        assert by[a.doc_id].near_next == p.likeness(mine, other)


# ----------------------------------------------------------- decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_contamination(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_decontamination_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in queries()["op5_benchmark_decontamination"](spark, DATA).collect()), key=repr)
    assert got == brute_contamination(docs, items)
    assert sum(r[5] for r in got) > 0


def test_decontamination_odd_items_in_blocks(spark, make):
    items = [(1, "the same few words here"), (2, "a"), (3, None), (4, ""), (None, "word word"), (5, "é" * 3000), (1, "no id"), (11, "Text TEXT, text")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_contamination(make(ODD), bench, block_bytes=10)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in found.collect()), key=repr)
    assert rows == [r[:4] for r in sorted(brute_contamination([(i, t) for i, t in ODD], items), key=repr)]
    nothing = decontam.contamination_report(make(ODD), bench.limit(0)).collect()
    assert len(nothing) == len(ODD) and not any(r.contaminated for r in nothing)
    kept = decontam.drop_contaminated(make(ODD), bench)
    assert kept.columns == make(ODD).columns
    assert kept.count() == sum(not r[2] for r in brute_contamination(ODD, items))
    assert decontam.drop_contaminated(make(ODD), bench, block_bytes=10).count() == kept.count()


def test_a_short_passage_in_a_long_text_is_contamination_enough(spark, make):
    """A passage that makes up three words in a hundred: the report calls it less than a twentieth, the stage drops it."""
    passage = " ".join(f"bench{i}" for i in range(15))
    rows = [(i, f"clean{i} " * 240 + passage * (i % 2) + f" clean{i}" * 240) for i in range(20)]
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    report = {r.doc_id: (r.n_hit, r.contaminated) for r in decontam.contamination_report(make(rows), bench).collect()}
    assert report == {i: (15 * (i % 2), False) for i in range(20)}
    assert sorted(r.doc_id for r in decontam.drop_contaminated(make(rows), bench).collect()) == list(range(0, 20, 2))


# ------------------------------------------------------------------- SimHash


def brute_simhash(docs):
    prints = []
    for _, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
        hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints))), key=repr)


def test_simhash_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    got = sorted((tuple(r) for r in queries()["op8_simhash_near_dedup"](spark, DATA).collect()), key=repr)
    assert got == brute_simhash(docs)
    assert len({r[2] for r in got}) < len(got)


def test_simhash_odd_input(make):
    got = sorted((tuple(r) for r in simhash.near_duplicate_report(make(ODD)).collect()), key=repr)
    assert got == brute_simhash([(i, t) for i, t in ODD])
    kept = simhash.drop_near_duplicates(make(ODD))
    assert kept.columns == make(ODD).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({r[2] for r in got if r[2] is not None})


def test_index_search_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [b ^ sum((np.uint64(1) << np.uint64(x) for x in rng.choice(64, rng.integers(0, 8), replace=False)), np.uint64(0)) for b in base for _ in range(9)]
    codes = np.unique(np.array([*base, *near], np.uint64))
    i, j = simhash.GrayIndex(codes).search(codes, 4)
    pairs = {(a, b) for a, b in zip(i.tolist(), j.tolist())}
    assert pairs == {(a, b) for a in range(len(codes)) for b in range(len(codes)) if int(codes[a] ^ codes[b]).bit_count() <= 4}


def test_hot_buckets_are_cut_again_without_losing_links(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    low = rng.integers(0, 2**20, 300)  # all share the upper bits: one bucket holds everything
    fps = sorted({int(x) for x in low})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    whole = {tuple(r) for r in simhash.components(simhash.links(df)).collect()}
    monkeypatch.setattr(simhash, "HOT", 50)
    assert {tuple(r) for r in simhash.components(simhash.links(df)).collect()} == whole and whole


# -------------------------------------------------------------- token counts


def test_token_counts_equal_brute_force(spark, make):
    encode = token_counts._encoder(open(token_counts.VOCABULARY, "rb").read(), token_counts.PATTERN).encode_ordinary
    for df, texts in ((docs_of(spark), [r.text for r in docs_of(spark).collect()]), (make(ODD), [t for _, t in ODD])):
        lengths = [len(encode(t or "")) for t in texts]
        sums = token_counts.suffix_sums(token_counts.length_histogram(df))
        got = {r.token_length: r for r in sums.collect()}
        assert {k: r.n_docs for k, r in got.items()} == Counter(lengths)
        for limit, r in got.items():
            assert r.kept_tokens == sum(min(n, limit) for n in lengths) and r.docs_ge == sum(n >= limit for n in lengths)
        limits = [0, 1, 7, 100, 512, 10**6]
        for r in token_counts.at_limits(sums, limits).collect():
            assert r.kept_tokens == sum(min(n, r.context_limit) for n in lengths) and r.docs_cut == sum(n > r.context_limit for n in lengths)
        ordered = sorted(lengths)
        for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
            assert r.token_length == ordered[max(0, -(-int(round(r.share * 1000)) * len(ordered) // 1000) - 1)]


def test_empty_tables(make):
    empty = make([(1, "x")]).limit(0)
    assert license_scan.scan(empty).count() == 0
    assert lz_fingerprint.edit_report(empty).count() == 0
    assert simhash.near_duplicate_report(empty).count() == 0
    assert token_counts.suffix_sums(token_counts.length_histogram(empty)).count() == 0


# --------------------------------------------------------------- url filter


def test_url_statistics_come_from_every_labelled_row(spark, monkeypatch):
    from folioforge.llm import url_filter

    urls = [f"https://a{i}.net/x" for i in range(30)] + [f"https://b{i}.org/fr/x" for i in range(30)] + [f"https://www.a{i}.net/y" for i in range(5)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    whole = sorted(tuple(r) for r in url_filter.judge(pages).collect())
    monkeypatch.setattr(url_filter, "TRAIN_ROWS", 2, raising=False)
    assert sorted(tuple(r) for r in url_filter.judge(pages).collect()) == whole
