"""Section documents and semantic chunks from flat nodes (cis, path, depth, type, content, ...)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.text import chunk_id, embed_text
from folioforge.operators.labels import HEADINGS
from folioforge.operators.load import lookup_one
from folioforge.sources.jsonl import below, per_record

SKIPPED = ("AmmAnnexeTitre", "DateNotif")
BANNED_SECTIONS, BANNED_CHUNKS = ("Ann3bSomm",), ("Ann3bEmballage",)
LEVEL2, HEADERS = "AmmAnnexeTitre2", ("AmmCorpsTexteGras", "AmmAnnexeTitre3")


#: Vocabulary of the domain, by anchor of the published document templates.
ALIASES = {
    "RcpCompoQualitQuanti": "RcpCompoQualiQuanti",
    "RcpContreIndic": "RcpContreindications",
    "RcpGrossAllait": "RcpFertGrossAllait",
    "RcpInteractions": "RcpInteractionsMed",
    "RcpPresentation": "RcpNumAutor",
    "RcpPropPharmacocinetique": "RcpPropPharmacocinetiques",
    "RcpPropPharmacodynamie": "RcpPropPharmacodynamiques",
    "RcpPropPharmacologie": "RcpPropPharmacologiques",
}
RCP_NUMBERS = {
    "2": "RcpCompoQualiQuanti",
    "4.7": "RcpConduite",
    "4.3": "RcpContreindications",
    "10": "RcpDateRevision",
    "1": "RcpDenomination",
    "4": "RcpDonneesCliniques",
    "6": "RcpDonneesPharmaceutiques",
    "11": "RcpDosimetrie",
    "6.3": "RcpDureeConservation",
    "4.8": "RcpEffetsIndesirables",
    "6.5": "RcpEmballage",
    "4.6": "RcpFertGrossAllait",
    "3": "RcpFormePharm",
    "6.2": "RcpIncompatibilites",
    "4.1": "RcpIndicTherap",
    "12": "RcpInstPrepRadioph",
    "4.5": "RcpInteractionsMed",
    "6.1": "RcpListeExcipients",
    "4.4": "RcpMisesEnGarde",
    "8": "RcpNumAutor",
    "4.2": "RcpPosoAdmin",
    "6.4": "RcpPrecConservation",
    "6.6": "RcpPrecEmpl",
    "9": "RcpPremiereAutorisation",
    "5.2": "RcpPropPharmacocinetiques",
    "5.1": "RcpPropPharmacodynamiques",
    "5": "RcpPropPharmacologiques",
    "5.3": "RcpSecuritePreclinique",
    "4.9": "RcpSurdosage",
    "7": "RcpTitulaireAmm",
}
NOTICE_NUMBERS = {
    "3": "Ann3bCommentPrendre",
    "5": "Ann3bConservation",
    "4": "Ann3bEffetsIndesirables",
    "6": "Ann3bEmballage",
    "2": "Ann3bInfoNecessaires",
    "1": "Ann3bQuestceque",
}
NOTICE_TITLES = {
    "classe pharmacotherapeutique": "Ann3bClassPharma",
    "effets sur l'aptitude a conduire des vehicules ou a utiliser des machines": "Ann3bConduite",
    "conservation": "Ann3bConservation",
    "contre-indications": "Ann3bContreIndic",
    "denomination du medicament": "Ann3bDenomination",
    "effets indesirables": "Ann3bEffetsIndesirablesDesc",
    "encadre": "Ann3bEncadre",
    "grossesse et allaitement": "Ann3bGrossAllait",
    "utilisation pendant la grossesse et l'allaitement": "Ann3bGrossAllait",
    "indications therapeutiques": "Ann3bIndicTherap",
    "liste des informations necessaires avant la prise du medicament": "Ann3bInfoAvantPrise",
    "surdosage": "Ann3bInstrucSurdosage",
    "interactions avec les produits de phytotherapie ou therapies alternatives": "Ann3bIntPhyto",
    "interactions avec d'autres medicaments": "Ann3bInteractions",
    "interactions avec les aliments et les boissons": "Ann3bInteractionsAliments",
    "liste des excipients a effet notoire": "Ann3bListeExcipientsNotoires",
    "precautions d'emploi ; mises en garde speciales": "Ann3bMisesEnGarde",
    "posologie": "Ann3bPosologie",
    "sportifs": "Ann3bSportifs",
}


_NUMBER = re.compile(r"([0-9]+(?:\.[0-9]+)?)\.")


def fold(text: str | None) -> str:
    ascii_ = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()
    return " ".join(ascii_.lower().split())


@F.pandas_udf(T.StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map({t: fold(t) for t in s.unique()})


def _lookup(key: Column, known: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), key)


def normal_anchor(anchor: str | None, title: str, kind: str) -> str:
    """The anchor's alias, else (for generated anchors) the one of the section number, else of the folded title, else as it is."""
    a = anchor or ""
    found = ALIASES.get(a)
    if found is None and a.startswith("_"):
        number = _NUMBER.match(title)
        found = (RCP_NUMBERS if kind == "rcp" else NOTICE_NUMBERS).get(number.group(1)) if number else None
        if found is None and kind != "rcp":
            found = NOTICE_TITLES.get(fold(title))
    return a if found is None else found


def normalise_anchors(df: DataFrame, anchor: str, title: str, kind: str) -> DataFrame:
    """normal_anchor() as a column, norm_anchor."""
    a, low = F.coalesce(F.col(anchor), F.lit("")), F.col(title)
    number = F.regexp_extract(F.coalesce(low, F.lit("")), r"^(\d+(?:\.\d+)?)\.", 1)
    found = _lookup(number, RCP_NUMBERS if kind == "rcp" else NOTICE_NUMBERS)
    if kind != "rcp":
        # only generated anchors need the fold, the one Python step here
        found = F.coalesce(found, _lookup(_fold(F.when(a.startswith("_"), low)), NOTICE_TITLES))
    return df.withColumn("norm_anchor", F.coalesce(_lookup(a, ALIASES), F.when(a.startswith("_"), found), a))


def _title(node: dict) -> str:
    return " ".join(node["content"] or []).strip()


def _items(node: dict) -> list[str]:
    return [x for x in (c.strip() for c in node["content"] or []) if x]


def _text(nodes: list[dict], at: int) -> str:
    """The plain text of a subtree in document order."""
    return " ".join(x for n in below(nodes, at) for x in _items(n))


def _section_docs(kind: str):
    def run(nodes: list[dict]) -> Iterator[tuple]:
        date, tops, kids = "", {}, {}
        for at, n in enumerate(nodes):
            if n["depth"] == 0:
                date = _title(n) if n["type"] == "DateNotif" else date
                if n["type"] not in SKIPPED and n["anchor"] not in BANNED_SECTIONS:
                    tops[n["path"]] = at, date
            elif kind == "rcp" and n["depth"] == 1 and n["type"] == LEVEL2 and n["anchor"]:
                kids.setdefault(n["parent"], []).append(at)
        for path, (at, date) in tops.items():
            for head in kids.get(path, [at]):
                n = nodes[head]
                title = _title(n)
                anchor = normal_anchor(n["anchor"], title, kind)
                text = _text(nodes, head) if anchor not in BANNED_SECTIONS else ""
                if text:
                    yield n["type"], anchor, title, text, date, n["path"]

    return run


def section_docs(nodes: DataFrame, names: DataFrame, kind: str) -> DataFrame:
    """One document per section: id, cis_code, spec_name, doc_type, section_type, section_anchor, section_title, text_content, date_notif, path.

    nodes: flat ones or records; names: cis, name. A date reaches only what follows it. RCP
    sections with anchored subsections give one document for each of these, else one for themselves.
    """
    docs = per_record(nodes, _section_docs(kind), "section_type string, section_anchor string, section_title string, text_content string, date_notif string, path string")
    out = lookup_one(docs, "cis", names, "name")
    return out.select(F.concat_ws("_", "cis", "section_anchor", F.lit(kind)).alias("id"), F.col("cis").alias("cis_code"), F.col("name").alias("spec_name"), F.lit(kind).alias("doc_type"), "section_type", "section_anchor", "section_title", "text_content", "date_notif", "path")


def _notice_chunks(nodes: list[dict]) -> Iterator[tuple]:
    kids: dict[str, list[int]] = {}
    for at, n in enumerate(nodes):
        if n["depth"] in (1, 2):
            kids.setdefault(n["parent"], []).append(at)

    def chunk(anchor: str, title: str, sub: str, parts: list[int]) -> Iterator[tuple]:
        text = " ".join(_text(nodes, at) for at in parts).strip()
        if text:
            yield anchor, title, sub, text, [h for h in (nodes[at]["html"] for at in parts) if h]

    for n in nodes:
        if n["depth"] or n["type"] in SKIPPED:
            continue
        title = _title(n)
        anchor = normal_anchor(n["anchor"], title, "notice")
        own = kids.get(n["path"], []) if anchor not in BANNED_CHUNKS else []
        titles = [at for at in own if nodes[at]["type"] == LEVEL2]
        for at in titles:
            sub = _title(nodes[at])
            yield from chunk(normal_anchor(nodes[at]["anchor"] or anchor, sub, "notice"), title, sub, kids.get(nodes[at]["path"], []))
        if not titles:
            sub, parts = "", []
            for at in own:
                if nodes[at]["type"] in HEADERS:
                    yield from chunk(anchor, title, sub, parts)
                    sub, parts = _title(nodes[at]), []
                else:
                    parts.append(at)
            yield from chunk(anchor, title, sub, parts)


def notice_chunks(nodes: DataFrame) -> DataFrame:
    """Semantic chunks: id, cis, section_anchor, section_title, sub_header, text, embed_text, html_snippets.

    nodes: flat ones or records. A section with level-2 titles gives a chunk for each of these;
    another is cut at bold lines and level-3 titles.
    """
    chunks = per_record(nodes, _notice_chunks, "section_anchor string, section_title string, sub_header string, text string, html_snippets array<string>")
    chunks = chunks.withColumn("embed_text", embed_text(F.col("section_title"), F.col("sub_header"), F.col("text")))
    return chunks.select(chunk_id(F.col("cis"), F.col("section_anchor"), F.col("embed_text")).alias("id"), "cis", "section_anchor", "section_title", "sub_header", "text", "embed_text", "html_snippets")


def texts_of_sections(nodes: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """cis and for each prefix, in a column of the name that it has here, the texts below the first
    level-2 title (under a level-1 annex title) that starts with it; null without such a title or
    anything below it. nodes: flat ones or records; each record is walked once."""

    def texts(nodes: list[dict], at: int) -> list[str] | None:
        found, any_ = [], False
        for n in islice(below(nodes, at), 1, None):
            any_ = True
            heading = n["type"] in ("AmmAnnexeTitre3", "AmmAnnexeTitre4")
            found += [x for x in _items(n) if not (heading and x.lower() in HEADINGS)] if n["type"] != LEVEL2 else []
        return found if any_ else None

    def run(nodes: list[dict]) -> Iterator[tuple]:
        tops = {n["path"] for n in nodes if n["depth"] == 0 and n["type"] == "AmmAnnexeTitre1"}
        second = [(at, _title(n)) for at, n in enumerate(nodes) if n["depth"] == 1 and n["type"] == LEVEL2 and n["parent"] in tops]
        first = [next((at for at, title in second if title.startswith(p)), None) for p in prefixes]
        if nodes:
            yield tuple(None if at is None else texts(nodes, at) for at in first)

    return per_record(nodes, run, ", ".join(f"`{name}` array<string>" for name in prefixes.values()))


def texts_of_section(nodes: DataFrame, prefix: str, name: str) -> DataFrame:
    """texts_of_sections() of one prefix: only the records that have such texts."""
    return texts_of_sections(nodes, {prefix: name}).filter(F.col(name).isNotNull())
