"""Permanent identifiers: seven base-32 characters and a check character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the alphabet, without letters that are easily confused.
ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
WIDTH = 7


def character(n: Column) -> Column:
    return F.substr(F.lit(ALPHABET), n + 1, F.lit(1))


def base32(n: Column, width: int = WIDTH) -> Column:
    """The width digits of n; a number that needs more, or is negative, raises an error rather than repeat another's."""
    n = F.when((n >= 0) & (n < F.lit(1 << 5 * width)), n).when(n.isNotNull(), F.raise_error(F.concat(F.lit("no room for number "), n.cast("string"))).cast("long"))
    return F.concat(*[character(F.shiftright(n, 5 * i).bitwiseAND(31).cast("int")) for i in reversed(range(width))])


def mint(n: Column, prefix: str = "") -> Column:
    """XXXX-XXXC after a prefix of the user's choice: the check character depends on n modulo 32 alone."""
    body = F.concat(base32(n), character(((n * 7 + 91) % 32).cast("int")))
    return F.concat(F.lit(prefix), F.left(body, F.lit(4)), F.lit("-"), F.right(body, F.lit(4)))


def is_valid(ident: Column, prefix: str = "") -> Column:
    """Whether the shape is right, whatever the case and punctuation. The check character isn't recomputed."""
    return F.rlike(F.upper(F.regexp_replace(F.coalesce(ident, F.lit("")), "[^A-Za-z0-9]", "")), F.lit(f"^{prefix.strip('-').upper()}[{ALPHABET}]{{8}}$"))
