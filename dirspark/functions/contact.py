"""Phones, web addresses, codes and hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPEATED = r"(\d)\1{5,}"
COUNTRY = "+91"
# Opening hours that are implausible for a shop.
IMPLAUSIBLE_HOURS = ("sunrise-sunset", "dawn-dusk", "sunset-sunrise")
# Fixed value: what makes an address read as a home.
HOME_WORDS = r"(?i)\b(h\.?no|house\s*no|door\s*no|flat|apartment|apt|residency|residence|nagar\s+colony|colony|quarters|villa|behind\s+house)\b"


def digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def national(d: Column, double_zero: bool = True) -> Column:
    """Digits without the country code or trunk prefix, as far as ten digits remain."""
    out = F.when(F.length(d).eqNullSafe(12) & F.startswith(d, F.lit("91")), F.substr(d, F.lit(3))).when(F.length(d).eqNullSafe(11) & F.startswith(d, F.lit("0")), F.substr(d, F.lit(2)))
    out = out.otherwise(d)
    return F.when(F.startswith(d, F.lit("0091")), F.substr(d, F.lit(5))).otherwise(out) if double_zero else out


def line_type(n: Column) -> Column:
    return F.when(F.rlike(n, F.lit("^[6-9]")), "mobile").otherwise("landline")


def strict_phone(raw: Column, double_zero: bool = True, reject: str = "^(1800|1860|1900|140)", repeats: bool = False) -> Column:
    """struct(phone, line_type) of an acceptable number, else null: ten digits, no service prefix, no digit six times (unless repeats are allowed)."""
    n = national(digits(raw), double_zero)
    ok = F.rlike(n, F.lit("^[1-9][0-9]{9}$")) & ~F.rlike(n, F.lit(reject)) & (F.lit(repeats) | ~F.rlike(n, F.lit(REPEATED)))
    return F.when(ok, F.struct(F.concat(F.lit(COUNTRY), n).alias("phone"), line_type(n).alias("line_type")))


def charging_phone(raw: Column) -> Column:
    return strict_phone(raw, double_zero=False, reject="^(1800|1860)")


def first_phone(raws: Column, repeats: bool = False) -> Column:
    """The first acceptable number of an array."""
    return F.try_element_at(F.filter(F.transform(raws, lambda x: strict_phone(x, repeats=repeats)), lambda p: p.isNotNull()), F.lit(1))


def loose_phone(*values: Column) -> Column:
    """struct(phone, line_type) of the first tag that yields one: first segment; ten digits from 6-9 a mobile, else 8-11 digits a landline."""

    def one(raw: Column) -> Column:
        n = national(digits(F.element_at(F.split(F.nullif(raw, F.lit("")), "[;,/]"), 1)), double_zero=False)
        mobile = F.rlike(n, F.lit("^[6-9][0-9]{9}$"))
        return F.when(mobile | F.length(n).between(8, 11), F.struct(F.concat(F.lit(COUNTRY), n).alias("phone"), F.when(mobile, "mobile").otherwise("landline").alias("line_type")))

    return F.coalesce(*[one(v) for v in values])


def phone_status(phone: Column) -> Column:
    """The first class that fits: none, tollfree, valid_mobile, valid_landline, suspicious_pattern, malformed."""
    return (
        F.when(phone.isNull(), F.lit(None).cast("string"))
        .when(F.rlike(phone, F.lit(r"^\+91(1800|1860|1900|140)")), "tollfree")
        .when(F.rlike(phone, F.lit(r"^\+91[6-9][0-9]{9}$")), "valid_mobile")
        .when(F.rlike(phone, F.lit(r"^\+91[1-5][0-9]{9}$")), "valid_landline")
        .when(F.rlike(phone, F.lit(REPEATED)), "suspicious_pattern")
        .otherwise("malformed")
    )


def web_address(*values: Column) -> Column:
    """First of the values, its first segment, with a scheme, no slash at the end, at most 255 characters."""
    u = F.trim(F.element_at(F.split(F.coalesce(*[F.nullif(v, F.lit("")) for v in values]), ";"), 1))
    with_scheme = F.when(F.rlike(u, F.lit("(?i)^https?://")), u).otherwise(F.concat(F.lit("https://"), u))
    return F.when(u != "", F.left(F.rtrim(with_scheme, F.lit("/")), F.lit(255)))


def six_digit_code(raw: Column, strip_decimal: bool = False) -> Column:
    t = F.trim(raw)
    t = F.regexp_replace(t, r"\.0$", "") if strip_decimal else t
    return F.when(F.rlike(t, F.lit("^[0-9]{6}$")), t)


def hours(raw: Column) -> Column:
    return F.when(~F.lower(F.trim(raw)).isin(*IMPLAUSIBLE_HOURS), F.trim(raw))


def population(raw: Column) -> Column:
    """Digits only; null where they are no number of a sensible size."""
    return digits(raw).try_cast("long")


def looks_residential(address: Column) -> Column:
    return F.rlike(address, F.lit(HOME_WORDS))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def file_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)
