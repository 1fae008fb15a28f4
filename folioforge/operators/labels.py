"""Rule engine: keyword and pattern scans over arrays of texts, labels A/B/C, reasons, evidence.

All of it is one projection of higher-order functions; plans hold no Python node.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import rx

KEYWORDS = ("pédiatrie", "pédiatrique", *(w + s for w in ("enfant", "nourrisson", "nouveau-né") for s in ("", "s")), "nouveaux-nés",
            *("prématuré" + s for s in ("", "s")), "infantile", *("adolescent" + s for s in ("", "s", "e", "es")), *("juvénile" + s for s in ("", "s")), "immature")
_AGED, _BOUND = r"\b(?:âgée?s?|age|âge)\s*(?:de\s*)?", r"(?:moins\s*de\s*|[<>]=?\s*|inférieure?\s*à\s*|supérieure?\s*à\s*)?"
AGE_PATTERNS = (
    _AGED + _BOUND + r"(?:1[0-8]|[0-9])\s*ans?\b",
    _AGED + _BOUND + r"(?:[0-9]+)\s*(?:mois|jours?)\b",
    *(rf"{start}\s*(?:1[0-7]|[0-9])\s*ans\b" for start in (r"\bplus\s*de", r"\bà\s*partir\s*de")),
    r"\b(?:poids|pesant)\s*(?:de\s*)?" + _BOUND + r"(?:[0-9]+(?:[.,][0-9]+)?)\s*kg\b",
)
NEGATIVE_PATTERNS = (
    *(f"ne {verb} pas être utilisée{many}" for verb, many in (("doit", "?"), ("doivent", "?s?"))),
    *(f"{be} pas {what}" for what in ("indiquée", "recommandée") for be, what in (("n'est", what + "?"), ("ne sont", what + "?s?"))),
    "pas recommandable",
    *(f"sécurité.*?efficacité.*?{have} pas été" for have in ("n'ont", "n'a", r"n'a\s*/\s*n'ont")),
    *(f"tolérance.*?efficacité.*?{have} pas été" for have in ("n'ont", "n'a")),
    *(f"n'a pas été {done}e?" for done in ("suffisamment démontré", "étudié")),
    *(f"{head} justifiée?" for head in ("n'est pas", "il n'existe pas d'utilisation")),
    "est déconseillée?",
    *(f"aucune {thing}" for thing in ("donnée.*?disponible", "étude.*?effectuée")),
    "données disponibles sont limitées",
    "peu de données",
    "pas possible de recommander",
    "en l'absence de données?",
    "absence d'expérience",
    "sans objet",
)
POSITIVE_PATTERN = r"(?:est|sont)\s+indiquée?s?"
ADULT_PATTERNS = (*(rf"réservée?s?\s+à\s+l{gap}adulte" for gap in ("'", r"\s+")), r"reservée?s?\s+a\s+l'adulte")
HEADINGS = tuple(sorted({"posologie", "population pédiatrique", "populations particulières", "durée du traitement", "mode d'administration"}))
TIE_BREAK = {"ABC": "AB", "BC": "B", "AC": "AC", "AB": "AB"}


@dataclass(frozen=True)
class Rules:
    """What the engine looks for; every table can be exchanged."""

    keywords: tuple[str, ...] = KEYWORDS
    ages: tuple[str, ...] = AGE_PATTERNS
    negatives: tuple[str, ...] = NEGATIVE_PATTERNS
    positive: str = POSITIVE_PATTERN
    adult: tuple[str, ...] = ADULT_PATTERNS
    code_prefix: str = "G03"
    strict: bool = False
    tie_break: dict[str, str] = field(default_factory=lambda: dict(TIE_BREAK))


def find_keywords(text: Column, rules: Rules = Rules()) -> Column:
    """Keywords that the text contains, in the order of the list, then all age matches; each once."""
    low = F.lower(text)
    literal = F.filter(F.array(*[F.lit(k) for k in rules.keywords]), lambda k: F.contains(low, k))
    ages = [F.regexp_extract_all(low, F.lit(rx(p)), F.lit(0)) for p in rules.ages]
    return F.array_distinct(F.concat(literal, *ages))


def has_keyword(text: Column, rules: Rules = Rules()) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for k in rules.keywords:
        out = out | F.contains(low, F.lit(k))
    for p in rules.ages:
        out = out | low.rlike(rx(p))
    return out


def first_negative(text: Column, rules: Rules = Rules()) -> Column:
    """The first negative pattern that matches, as its own text, or null; literals compile once."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.rlike(rx(p)), F.lit(p)) for p in rules.negatives])


def has_indication(text: Column, rules: Rules = Rules()) -> Column:
    return F.lower(text).rlike(rx(rules.positive))


def adult_reserved(text: Column, rules: Rules = Rules()) -> Column:
    low, out = F.lower(text), F.lit(False)
    for p in rules.adult:
        out = out | low.rlike(rx(p))
    return out


def break_tie(signature: Column, rules: Rules = Rules()) -> Column:
    """Signatures of two letters or more by the table; one without an entry stays."""
    out = signature
    for key, value in rules.tie_break.items():
        out = F.when(signature == key, value).otherwise(out)
    return F.when(F.length(signature) >= 2, out).otherwise(signature)


def classify(df: DataFrame, main: str = "texts_main", contra: str = "texts_contra", code: str = "code", rules: Rules = Rules()) -> DataFrame:
    """Adds label_a, label_b, label_c, reasons_a, reasons_b, reasons_c, evidence_main, evidence_contra.

    main, contra: arrays of texts; code: a classification code. Null arrays count as empty.
    """
    empty = F.array().cast("array<string>")
    texts, against = F.coalesce(F.col(main), empty), F.coalesce(F.col(contra), empty)
    match = lambda t: F.struct(t.alias("text"), find_keywords(t, rules).alias("keywords"), first_negative(t, rules).alias("negative"), has_indication(t, rules).alias("indication"))
    hits = lambda a: F.filter(F.transform(a, match), lambda m: F.size(m["keywords"]) > 0)
    positive = (lambda m: m["negative"].isNull() & m["indication"]) if rules.strict else (lambda m: m["negative"].isNull())
    df = df.withColumns({"_m": hits(texts), "_x": hits(against), "_all": F.array_join(texts, " ")})
    any_ = F.size("_m") > 0
    pos, neg = F.exists("_m", positive), F.exists("_m", lambda m: m["negative"].isNotNull())
    bare = (F.exists("_m", lambda m: m["negative"].isNull() & ~m["indication"]) & ~pos) if rules.strict else F.lit(False)
    coded = F.coalesce(F.upper(F.col(code)).startswith(rules.code_prefix), F.lit(False))
    reasons = [(neg, "mention pédiatrique négative"), (bare, "mention pédiatrique sans indication"), (~any_, "aucune mention pédiatrique"), (adult_reserved(F.col("_all"), rules), "réservé à l'adulte"), (coded, "contraceptif")]
    listed = lambda some: F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in some]), lambda x: x.isNotNull())
    df = df.withColumns({
        "reasons_a": listed([(pos, "mention pédiatrique positive")]),
        "reasons_b": listed([(F.size("_x") > 0, "contre-indication pédiatrique")]),
        "reasons_c": listed(reasons),
    })
    signature = F.concat(*[F.when(F.size(f"reasons_{x}") > 0, x.upper()).otherwise("") for x in "abc"])
    df = df.withColumn("_sig", break_tie(signature, rules))
    shown = F.filter("_m", lambda m: m["negative"].isNotNull() | m["indication"]) if rules.strict else F.col("_m")
    return df.withColumns({f"label_{x}": F.contains("_sig", F.lit(x.upper())) for x in "abc"} | {"evidence_main": shown, "evidence_contra": F.col("_x")}).drop("_m", "_x", "_all", "_sig")


def report_rows(df: DataFrame, key: str) -> DataFrame:
    """Flat rows for a delimited file: labels as 0 and 1, lists joined by bars, texts cut at 200 characters."""
    joined = lambda c: F.array_join(c, " | ")
    kws = lambda c: joined(F.array_distinct(F.flatten(F.transform(c, lambda m: m["keywords"]))))
    cut = lambda c: F.array_join(F.transform(c, lambda m: F.left(m["text"], F.lit(200))), " ||| ")
    return df.select(key, *[F.col(f"label_{x}").cast("int").alias(f"label_{x}") for x in "abc"], *[joined(f"reasons_{x}").alias(f"reasons_{x}") for x in "abc"],
                     kws("evidence_main").alias("keywords_main"), cut("evidence_main").alias("texts_main"), kws("evidence_contra").alias("keywords_contra"), cut("evidence_contra").alias("texts_contra"))
