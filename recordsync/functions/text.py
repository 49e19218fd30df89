"""Column normalisers (scalar functions).

Every function maps Columns to a Column with Spark built-ins only, so it stays
inside whole-stage codegen.  ``c`` accepts a Column or a column name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ACCENTED, EXEMPT_CODE, EXEMPT_TEXT, PLAIN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 / F8 -------------------------------------------------------------------
def remove_accents(c) -> Column:
    """F8: map accented Latin letters to plain ones (``ß`` kept)."""
    return F.translate(_c(c), ACCENTED, PLAIN)


def normalize_key(c) -> Column:
    """F1+F8: upper-case, accent-free matching key (case/accent-insensitive joins).

    ``ß`` is folded to ``SS`` explicitly so the key does not depend on the
    engine's upper-casing of it."""
    return F.upper(F.replace(remove_accents(c), F.lit("ß"), F.lit("ss")))


# F2 / F3 -------------------------------------------------------------------
def pad_taxid(c, width: int = 14) -> Column:
    """left-pad with zeros to ``width``; longer input is cut, like lpad."""
    return F.lpad(_c(c).cast("string"), width, "0")


def zfill(c, width: int = 14) -> Column:
    """F2 (payload side): Python ``zfill``: pad with zeros, never cut."""
    x = _c(c).cast("string")
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, "0"))


def taxid_key(c, width: int = 14) -> Column:
    """``ltrim(lpad(x, 14, '0'))``; NULL for a value that lpad would cut,
    so a tax id that is too long matches nobody instead of another client."""
    return F.when(~taxid_too_long(c, width), F.ltrim(pad_taxid(c, width)))


def taxid_too_long(c, width: int = 14) -> Column:
    """True when lpad would silently cut the value (reject instead)."""
    return F.length(_c(c).cast("string")) > width


# F4 / F5 / F9 --------------------------------------------------------------
def decode_eq(c, value, then, otherwise=None) -> Column:
    """``DECODE(c, value, then, otherwise)`` — null-safe equality switch."""
    return F.when(_c(c).eqNullSafe(F.lit(value)), then).otherwise(otherwise)


def oracle_concat(*cols) -> Column:
    """Oracle ``||``: NULL operands act as empty strings."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


# F7 ------------------------------------------------------------------------
def initcap_words(c) -> Column:
    """capitalise every alphanumeric run (a word starts after any
    non-alphanumeric character, not only after a space)."""
    parts = F.regexp_extract_all(_c(c), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                              F.lower(F.substring(w, 2, 1 << 30)))), "")


# F10 / F11 -----------------------------------------------------------------
def ts_ntz(value: str) -> Column:
    """Timestamp literal without time zone (the driver tables are NTZ)."""
    return F.lit(value).cast("timestamp_ntz")


def trunc_day(c) -> Column:
    """Oracle ``TRUNC(date)``."""
    return F.date_trunc("day", _c(c)).cast("timestamp_ntz")


def day_window(c, base_ts: str, days: int) -> Column:
    """F10+P6: ``TRUNC(c) BETWEEN base AND base + days`` as a plain range on
    ``c`` with literal bounds, so the predicate reaches the parquet scan
    (row-group skipping) instead of being evaluated after a ``date_trunc``.

    ``TRUNC(c) >= base``  <=>  ``c >= first midnight at or after base``;
    ``TRUNC(c) <= base + days``  <=>  ``c < midnight after (base + days)``.
    """
    import datetime as _dt
    base = _dt.datetime.fromisoformat(base_ts)
    day0 = _dt.datetime.combine(base.date(), _dt.time())
    lower = day0 if base == day0 else day0 + _dt.timedelta(days=1)
    upper = _dt.datetime.combine((base + _dt.timedelta(days=days)).date(), _dt.time()) + _dt.timedelta(days=1)
    x = _c(c)
    return (x >= ts_ntz(lower.isoformat(sep=" "))) & (x < ts_ntz(upper.isoformat(sep=" ")))


def plus_days(ts: Column, days: int) -> Column:
    """``date + n``."""
    return ts + F.expr(f"INTERVAL {int(days)} DAYS")


# F12 - F17 -----------------------------------------------------------------
def strip_punct(c) -> Column:
    """remove '.' and '-' (zip codes, phones, registrations)."""
    return F.translate(_c(c), ".-", "")


def slug(c) -> Column:
    """file-name slug: space -> '_', drop '/', '.', ','."""
    return F.translate(_c(c), " /.,", "_")


def truncate(c, n: int) -> Column:
    """keep the first n characters."""
    return F.substring(_c(c), 1, n)


def first_token(c) -> Column:
    """first whitespace-separated token."""
    return F.split(F.trim(_c(c)), r"\s+").getItem(0)


def street_token(c) -> Column:
    """text before the first ',' then before the first '-' (trimmed)."""
    return F.trim(F.substring_index(F.substring_index(_c(c), ",", 1), "-", 1))


def int_part(c) -> Column:
    """F16: integer part of a numeric text ('123.0' -> '123')."""
    return F.substring_index(_c(c).cast("string"), ".", 1)


def house_number(c) -> Column:
    """house number as int; unparsable or 'SN' -> 0, missing -> 0."""
    return F.coalesce(_c(c).try_cast("int"), F.lit(0))


def house_number_out(c) -> Column:
    """F17 outbound: missing number -> 'SN'."""
    return F.coalesce(_c(c).cast("string"), F.lit("SN"))


# F18 / F19 -----------------------------------------------------------------
def registration_to_crm(c) -> Column:
    """ERP registration -> CRM: '99'/'0'/missing -> ISENTO."""
    x = _c(c).cast("string")
    return F.when(x.isNull() | x.isin(EXEMPT_CODE, "0"), F.lit(EXEMPT_TEXT)).otherwise(x)


def registration_to_erp(c) -> Column:
    """CRM registration -> ERP: ISENTO/'99'/'0'/missing -> '99'."""
    x = _c(c).cast("string")
    return F.when(x.isNull() | (F.upper(x) == EXEMPT_TEXT) | x.isin(EXEMPT_CODE, "0"),
                  F.lit(EXEMPT_CODE)).otherwise(strip_punct(x))


def flag_to_sn(c) -> Column:
    """JSON boolean text -> 'S'/'N'; anything else -> NULL (invalid)."""
    x = F.lower(_c(c).cast("string"))
    return F.when(x == "true", "S").when(x == "false", "N")


def sn_to_bool(c) -> Column:
    """'S'/'Y' -> true, 'N' -> false, else NULL (invalid)."""
    x = F.upper(_c(c))
    return F.when(x.isin("S", "Y"), F.lit(True)).when(x == "N", F.lit(False))


def bool_to_yn(c) -> Column:
    return F.when(_c(c), F.lit("Y")).otherwise(F.lit("N"))


# F21 / F23 / F24 / F25 -----------------------------------------------------
def nbsp_to_space(c) -> Column:
    """non-breaking space -> space."""
    return F.translate(_c(c), "\u00a0", " ")


def price_fallback(negotiated, price) -> Column:
    """negotiated price, or list price when it is null or 0."""
    return F.coalesce(F.nullif(_c(negotiated), F.lit(0)), _c(price))


NULL_MARK = "\u0000"


def row_fingerprint(*cols) -> Column:
    """MD5 of the '|'-joined row, NULL marked so (a,NULL,b) != (a,b,NULL)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit(NULL_MARK)) for c in cols]))


def stage_ordinal(c, stages: list[str]) -> Column:
    """1-based position of a stage; 0 when unknown, NULL when NULL."""
    return F.array_position(F.array(*[F.lit(s) for s in stages]), nbsp_to_space(c))
