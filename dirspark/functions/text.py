"""Names and texts: canonical forms, cleaning, slugs, similarity and keyword matching. Built-in functions throughout.

Only exact NFKC/NFKD normalisation needs Python; it is vectorised and optional (exact=True).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Words that each canonical form drops.
CANON_DROPS = {
    "names": "the|and|shop|store|stores|centre|center",
    "companies": "the|and|shop|store|stores|centre|center|pvt|ltd|private|limited",
    "register": "the|and|shop|store|stores|centre|center|pvt|ltd|private|limited|m s|ms|sri|shri|new",
    "udyam": "the|and|m s|ms|sri|shri|new|pvt|ltd|private|limited|enterprises?|enterprise|traders?|trading",
}
# Letters with marks and the letter that NFKD leaves (the mark itself becomes a blank).
MARKED = {"a": "àáâãäåāăą", "c": "çćĉċč", "d": "ď", "e": "èéêëēĕėęě", "g": "ĝğġģ", "h": "ĥ", "i": "ìíîïĩīĭįİ", "j": "ĵ", "k": "ķ", "l": "ĺļľ", "n": "ñńņň", "o": "òóôõöōŏő", "r": "ŕŗř", "s": "śŝşš", "t": "ţť", "u": "ùúûüũūŭůűų", "w": "ŵ", "y": "ýÿŷ", "z": "źżž"}


def normaliser(form: str):
    """A vectorised Unicode normalisation, for text beyond Latin letters."""

    @pandas_udf("string")
    def normalise(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata

        for part in parts:
            yield part.map(lambda x: unicodedata.normalize(form, x), na_action="ignore")

    return normalise


def unmarked(text: Column) -> Column:
    """Lower-case text whose marked Latin letters are the letter and a blank. Plain ASCII passes untouched."""
    low = F.lower(text)
    out = low
    for plain, marked in MARKED.items():
        out = F.regexp_replace(out, f"[{marked}]", plain + " ")
    return F.when(F.rlike(low, F.lit(r"[^\x00-\x7F]")), out).otherwise(low)


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def canon(text: Column, form: str = "names", exact: bool = False) -> Column:
    """The canonical form of a name. A name in another script has the form ''. Null stays null."""
    if form == "plain":
        return squeezed(F.lower(text))
    if form == "places":  # post-office endings, with and without dots
        low = F.regexp_replace(F.lower(normaliser("NFKD")(text)) if exact else unmarked(text), r"\b([hsb]\.o\.?|bo|so|ho)(?![a-z0-9])", " ")
        return squeezed(F.regexp_replace(low, "[^a-z0-9 ]", " "))
    if form == "bounded_places":  # endings with dots and what stands in brackets
        low = F.regexp_replace(F.lower(normaliser("NFKD")(text)) if exact else unmarked(text), r"\([^)]*\)|\b[hsb]\.o\.?", " ")
        return squeezed(F.regexp_replace(low, "[^a-z0-9 ]", " "))
    low = F.lower(text) if form == "udyam" else F.lower(normaliser("NFKD")(text)) if exact else unmarked(text)
    return squeezed(F.regexp_replace(F.regexp_replace(low, "[^a-z0-9 ]", " "), rf"\b({CANON_DROPS[form]})\b", " "))


def display_name(text: Column, exact: bool = False) -> Column:
    return F.left(squeezed(normaliser("NFKC")(text) if exact else text), F.lit(180))


def clean(text: Column, limit: int) -> Column:
    """Controls go before blanks are squeezed, so a line feed joins words; empty is null."""
    bare = squeezed(F.regexp_replace(text, r"[\x00-\x1f]", ""))
    return F.nullif(F.left(bare, F.lit(limit)), F.lit(""))


def slug(name: Column, ident: Column) -> Column:
    return F.concat(F.left(F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-")), F.lit(150)), F.lit("-"), ident)


def title(slug_: Column) -> Column:
    return F.initcap(F.replace(slug_, F.lit("-"), F.lit(" ")))


def joined(*parts: Column) -> Column:
    """Non-null parts with blanks between; null if nothing is left."""
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def labelled(name: Column, label: Column, locality: Column) -> Column:
    return F.concat(name, F.lit(" — "), label, F.coalesce(F.concat(F.lit(", "), locality), F.lit("")))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of lower-case words, each padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))))
    return F.array_distinct(grams)


def similarity(a: Column, b: Column) -> Column:
    """Shared over all trigrams; 0 if either has none."""
    return gram_similarity(trigrams(a), trigrams(b))


def gram_similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(common.cast("double"), (F.size(a) + F.size(b) - common).cast("double")), F.lit(0.0))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def first_hint(name: Column, hints: list[tuple[str, str]]) -> Column:
    """struct(slug, evidence) of the first pattern that matches; null if none does."""
    out = F.lit(None).cast("struct<slug:string,evidence:string>")
    for pattern, slug_ in reversed(hints):
        out = F.when(F.rlike(name, F.lit("(?i)" + pattern)), F.struct(F.lit(slug_).alias("slug"), F.lit(pattern[:44]).alias("evidence"))).otherwise(out)
    return out
