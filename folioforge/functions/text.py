"""Text functions as Column expressions; no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regex flags that make Java's classes behave like a Unicode-aware engine with unix lines.
UNICODE = "(?Ud)"
_SPACE = r"[\s\x1c-\x1f]"
_SUP = ("0123456789abcdefghijklmnoprstuvwxyzABDEGHIJKLMNOPRTUVW+-=()", "⁰¹²³⁴⁵⁶⁷⁸⁹ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻᴬᴮᴰᴱᴳᴴᴵᴶᴷᴸᴹᴺᴼᴾᴿᵀᵁⱽᵂ⁺⁻⁼⁽⁾")
_SUB = ("0123456789aehijklmnoprstuvx+-=()", "₀₁₂₃₄₅₆₇₈₉ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓ₊₋₌₍₎")
CDN = "https://cdn.example.org/images/"


def rx(pattern: str, ignore_case: bool = False) -> str:
    return f"(?Ud{'i' * ignore_case})" + pattern


def strip_u(c: Column) -> Column:
    """Removes leading and trailing white space of any kind, no-break spaces included."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def normalise_text(c: Column) -> Column:
    """Typographic apostrophes and dashes to ASCII, comparison signs to two characters."""
    plain = F.translate(c, "’‘‑–", "''--")
    return F.replace(F.replace(plain, F.lit("≥"), F.lit(">=")), F.lit("≤"), F.lit("<="))


_PLAIN = str.maketrans({"’": "'", "‘": "'", "‑": "-", "–": "-", "≥": ">=", "≤": "<="})


def normal_py(text: str) -> str:
    return text.translate(_PLAIN)


def superscript(c: Column) -> Column:
    return F.translate(c, *_SUP)


def subscript(c: Column) -> Column:
    return F.translate(c, *_SUB)


def sup_py(text: str) -> str:
    return text.translate(str.maketrans(*_SUP))


def sub_py(text: str) -> str:
    return text.translate(str.maketrans(*_SUB))


def rewrite_images(html: Column, cdn: str = CDN) -> Column:
    """Relative image paths to absolute ones, tags self-closed; texts without a lower-case <img stay."""
    done = F.regexp_replace(html, r'(?i)<img([^>]*?)src="\.\./images/([^"]+)"([^>]*?)(?:\s*/)?>', f'<img$1src="{cdn}$2"$3 />')
    return F.when(html.contains("<img"), done).otherwise(html)


def unanchor(html: Column) -> Column:
    """Named anchors removed, what they enclose kept."""
    return F.regexp_replace(html, r"(?s)<a name=[^>]*>(.*?)</a>", "$1")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def node_text(content: Column) -> Column:
    """Items of a node's content joined by spaces and stripped; null: empty."""
    return F.coalesce(strip_u(F.array_join(content, " ")), F.lit(""))


def embed_text(title: Column, sub: Column, body: Column) -> Column:
    return F.when(sub != "", F.concat(title, F.lit(" > "), sub, F.lit(": "), body)).otherwise(F.concat(title, F.lit(": "), body))


def chunk_id(key: Column, anchor: Column, embedded: Column) -> Column:
    return F.concat_ws("_", key, anchor, F.substring(F.md5(embedded.cast("binary")), 1, 8))


def code_ancestors(code: Column) -> Column:
    """Prefixes of 1, 3, 4, 5 and 7 characters, as far as the code reaches, shortest first."""
    sizes = F.filter(F.array(*[F.lit(n) for n in (1, 3, 4, 5, 7)]), lambda n: n <= F.length(code))
    return F.transform(sizes, lambda n: F.left(code, n))


def ordered_unique(*arrays: Column) -> Column:
    return F.array_distinct(F.concat(*arrays))


def decode_bytes(content: Column) -> Column:
    """UTF-8 where the bytes are valid, else as Windows-1252 (by a table, since Spark's decode has no such name)."""
    utf8 = content.cast("string")
    high = "".join(bytes([b]).decode("cp1252", "replace") for b in range(128, 160))
    latin = F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, range(128, 160))), high)
    return F.when(F.is_valid_utf8(utf8), utf8).otherwise(latin)


ELISIONS = ("jusqu", "lorsqu", "puisqu", "quoiqu", "qu", "c", "d", "j", "l", "m", "n", "s", "t")
STOPWORDS = "au aux avec ce ces dans de des du elle en et eux il ils je la le les leur lui ma mais me meme mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous c d j l a m n s t y est sont ete etre".split()
_FOLD = ("àâäáãåçèéêëìíîïñòóôöõùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def analyse_french(text: Column) -> Column:
    """Tokens for search: lower case, elisions and accents off, stop words out, light stems.

    The stems follow the published light approach (plural and common endings), by expressions.
    """
    low = F.replace(F.lower(text), F.lit("’"), F.lit("'"))
    cut = F.regexp_replace(low, rf"(?U)\b(?:{'|'.join(ELISIONS)})'", "")
    folded = F.replace(F.replace(F.translate(cut, *_FOLD), F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae"))
    tokens = F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda t: (t != "") & ~t.isin(STOPWORDS))
    return F.transform(tokens, _light_stem)


def _light_stem(t: Column) -> Column:
    for ending, least, new in (("aux$", 6, "al"), ("[xs]$", 4, ""), ("issement$", 10, "ir"), ("ement$", 8, ""), ("euse$", 6, "eu"), ("(?:ee|er|e)$", 5, ""), ("(.)\\1$", 5, "$1")):
        t = F.when(F.length(t) >= least, F.regexp_replace(t, ending, new)).otherwise(t)
    return t
