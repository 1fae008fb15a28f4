"""URL filters: allow and block rules, and gradient-boosted trees for what no rule decides.

Rules name a host (with all its subdomains) and a path that a URL's path starts with; the
longest one that fits wins. The URLs that a rule decides are the labelled ones, from which
trees on lexical features are trained: length, depth, share of digits, entropy, numbers of
parameters and labels, and how often labelled URLs of the same last label on other domains,
and of the same last two labels on other hosts, were blocked.

Everything is DataFrame expressions. Features are binned; each level of each tree takes one
aggregation over the labelled rows: gradients summed by leaf, feature and bin, whole numbers
(fixed point), so that sums don't depend on the order of rows. At most leaves x features x
bins rows reach the driver, which picks the splits; the model is a sum of CASE expressions.

Defined cases: a null url, or one without ://, has empty host and path and is judged by the
method; repeated rows are judged row by row; with labels of one kind only, all get that
kind, without any, all are allowed; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import stable

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
TREES, DEPTH, RATE, LAMBDA = 8, 2, 0.5, 1.0
_ONE = 1 << 20


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) part after the first :// up to /, ?, # or the end; null or none: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(df: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Adds rule (like net/ or example.net/en/) and rule_verdict, both null if none fits."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in reversed(longest):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def entropy(text: Column) -> Column:
    """Bits per character, by the counts of the distinct characters."""
    chars = F.array_distinct(F.split(text, ""))
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda s, c: s - F.when(F.length(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))).otherwise(0.0)


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def lexical(df: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself, each as a small whole number (its bin)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    bins = {
        "f_length": F.least(F.floor(n / 6), F.lit(31)),
        "f_depth": F.least(_count(F.col("path"), "/"), F.lit(15)),
        "f_digits": F.floor(F.when(n > 0, digits / n).otherwise(0.0) * 20),
        "f_entropy": F.floor(entropy(url) * 4),
        "f_parameters": F.least(_count(url, "=") + _count(url, "&"), F.lit(15)),
        "f_labels": F.least(_count(F.col("host"), "."), F.lit(15)),
        "f_host": F.least(F.floor(F.length("host") / 3), F.lit(31)),
        "f_hyphens": F.least(_count(F.col("host"), "-"), F.lit(7)),
        "f_secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    return df.withColumns({k: v.cast("int") for k, v in bins.items()} | {"k_suffix": F.substring_index("host", ".", -1), "k_domain": F.substring_index("host", ".", -2)})


FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_labels", "f_host", "f_hyphens", "f_secure", "f_suffix", "f_domain")


def _with_statistics(df: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds how often labelled URLs of the same suffix on other domains, and of the same domain (the
    last two labels) on other hosts, were blocked.

    A URL's own label, and those that go with it, are thus never in its features: neither while
    the trees are trained nor when they judge. Sixteen steps of the smoothed share; without such
    URLs it is the middle. Keys may be many and hot: counts are aggregated before they are
    joined, and the join isn't forced.
    """
    sums = lambda by, name: by.agg(F.sum("y").alias(f"y_{name}"), F.sum("c").alias(f"c_{name}"))
    host = sums(labelled.withColumn("c", F.lit(1)).groupBy("k_suffix", "k_domain", "host"), "host")
    renamed = host.withColumnsRenamed({"y_host": "y", "c_host": "c"})
    domain = sums(renamed.groupBy("k_domain"), "domain")
    suffix = sums(renamed.groupBy("k_suffix"), "suffix")
    df = df.join(suffix, "k_suffix", "left").join(domain, "k_domain", "left").join(host.select("host", "y_host", "c_host"), "host", "left")
    of = lambda kind, name: F.coalesce(f"{kind}_{name}", F.lit(0))
    share = lambda a, b: F.floor((of("y", a) - of("y", b) + 1) / (of("c", a) - of("c", b) + 2) * 16).cast("int")
    return df.withColumns({"f_suffix": share("suffix", "domain"), "f_domain": share("domain", "host")}).drop(*[f"{k}_{n}" for k in "yc" for n in ("host", "domain", "suffix")])


def _leaf(tree: list) -> Column:
    """A row's value, as nested conditions."""
    if tree[0] == "leaf":
        return F.lit(float(tree[1]))
    _, feature, at, low, high = tree
    return F.when(F.col(feature) <= at, _leaf(low)).otherwise(_leaf(high))


def _paths(tree: list, path: str = "n") -> Column:
    """The name of a row's leaf: n, and 0 or 1 for each turn."""
    if tree[0] == "leaf":
        return F.lit(path)
    _, feature, at, low, high = tree
    return F.when(F.col(feature) <= at, _paths(low, path + "0")).otherwise(_paths(high, path + "1"))


def _grow(rows: DataFrame, margin: Column, depth: int, rate: float, penalty: float) -> list:
    """One tree, a level at a time, from sums of gradients by leaf, feature and bin."""
    tree: list = ["leaf", 0.0]
    p = 1 / (1 + F.exp(-margin))
    data = rows.withColumns({"g": F.round((F.col("y") - p) * _ONE).cast("long"), "h": F.round(p * (1 - p) * _ONE).cast("long")})
    for _ in range(depth):
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in FEATURES]))
        sums = data.select(_paths(tree).alias("leaf"), each.alias("x"), "g", "h", "n").groupBy("leaf", "x.f", "x.bin").agg(F.sum(F.col("g") * F.col("n")).alias("g"), F.sum(F.col("h") * F.col("n")).alias("h"))
        by_leaf: dict = {}
        for r in sums.collect():  # leaves x features x bins rows
            by_leaf.setdefault(r["leaf"], {}).setdefault(r["f"], []).append((r["bin"], r["g"] / _ONE, r["h"] / _ONE))
        tree = _split(tree, "n", by_leaf, rate, penalty)
    return tree


def _split(tree: list, path: str, by_leaf: dict, rate: float, penalty: float) -> list:
    if tree[0] != "leaf":
        return [*tree[:3], _split(tree[3], path + "0", by_leaf, rate, penalty), _split(tree[4], path + "1", by_leaf, rate, penalty)]
    features = by_leaf.get(path)
    if not features:
        return tree
    some = next(iter(features.values()))
    g, h = sum(x[1] for x in some), sum(x[2] for x in some)
    best = (1e-6, None)
    for name in sorted(features):
        left_g = left_h = 0.0
        for at, bg, bh in sorted(features[name])[:-1]:
            left_g, left_h = left_g + bg, left_h + bh
            gain = left_g**2 / (left_h + penalty) + (g - left_g) ** 2 / (h - left_h + penalty) - g**2 / (h + penalty)
            if gain > best[0] + 1e-9:
                best = (gain, (name, at, rate * left_g / (left_h + penalty), rate * (g - left_g) / (h - left_h + penalty)))
    if best[1] is None:
        return ["leaf", rate * g / (h + penalty)]
    name, at, low, high = best[1]
    return ["split", name, at, ["leaf", low], ["leaf", high]]


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, penalty: float = LAMBDA) -> Column:
    """The margin (above 0: block) as an expression over FEATURES; labelled: FEATURES and y (1: block).

    Rows of equal features are counted together first, so each aggregation runs over the
    distinct feature vectors only.
    """
    rows = stable(labelled.groupBy(*FEATURES, "y").agg(F.count("*").alias("n")))
    total = rows.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y")).first()
    n, y = total["n"] or 0, total["y"] or 0
    if not n:
        return F.lit(-1.0)
    if y in (0, n):
        return F.lit(1.0 if y else -1.0)
    margin = F.lit(math.log(y / (n - y)))
    for _ in range(trees):
        margin = margin + _leaf(_grow(rows, margin, depth, rate, penalty))
    return margin


def judge(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), rules: tuple = RULES) -> DataFrame:
    """keep, host, path, rule, verdict and score (the method's probability of block) of every page."""
    base = with_rule(pages.select(*keep, F.col("url").cast("string").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}), rules)
    base = stable(lexical(base).drop("url"))
    labelled = base.filter("rule_verdict is not null").withColumn("y", (F.col("rule_verdict") == "block").cast("int"))
    margin = train(_with_statistics(labelled, labelled))
    all_ = _with_statistics(base, labelled).withColumn("score", 1 / (1 + F.exp(-margin)))
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return all_.select(*keep, "host", "path", "rule", verdict.alias("verdict"), "score")
