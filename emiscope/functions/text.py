"""Text and number expressions. Everything here is a native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emiscope.schemas import DEFAULT_WAIT_SECONDS, UNIT_WORDS

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_REAL = rf"(?:{_DIGITS}(?:[.](?:{_DIGITS})?)?|[.]{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_NUMBER = rf"^[+-]?(?:{_REAL}|(?i:inf(?:inity)?|nan))$"


def strip(text: Column) -> Column:
    """Trim all leading and trailing white space, tabs and line ends included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_float(text: Column) -> Column:
    """Text to double, NULL when it is not a number.

    The pattern keeps out forms only Spark reads (``12d``) and lets in digit
    groups (``1_000``), ``nan`` and ``inf``.
    """
    # One pass, so that long input expressions are not repeated. A cast of '' gives
    # NULL, and "nan" is cast without its sign.
    whole = F.regexp_extract(strip(text.cast("string")), _NUMBER, 0)
    return F.regexp_replace(whole, r"_|^[+-](?=[nN])", "").try_cast("double")


def parse_int(text: Column) -> Column:
    """Text to bigint, cut toward zero; 0 when it is no finite number."""
    return F.coalesce(parse_float(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_emission(text: Column) -> Column:
    """Emission text to double after erasing unit words. Units are not converted."""
    cleaned = F.lower(strip(text))
    for word in UNIT_WORDS:
        cleaned = F.replace(cleaned, F.lit(word), F.lit(""))
    return parse_float(cleaned)


def exact_decimal(number: Column) -> Column:
    """Double to the decimal its shortest text names, not its binary expansion."""
    return number.cast("string").try_cast("decimal(38,18)")


def wait_seconds(header: Column) -> Column:
    """Retry header to whole seconds, at least 1; the default when absent or bad."""
    parsed = parse_float(F.nullif(header, F.lit(""))).try_cast("bigint")
    default = F.lit(DEFAULT_WAIT_SECONDS).cast("bigint")
    return F.when(parsed.isNull(), default).otherwise(F.greatest(parsed, F.lit(1).cast("bigint")))


def float_text(text: Column) -> Column:
    """Shortest text of a double in the ``0.5`` / ``1e-05`` / ``1e+16`` notation."""
    value = text.try_cast("double")
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    sci = value.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(sci, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(sci, r"E(-?[0-9]+)$", 1)
    digits = F.lpad(F.regexp_replace(power, "-", ""), 2, "0")
    sign = F.when(power.startswith("-"), F.lit("e-")).otherwise(F.lit("e+"))
    magnitude = F.abs(value)
    return (
        F.when(magnitude == 0, F.when(text.startswith("-"), "-0.0").otherwise("0.0"))
        .when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when((magnitude >= 1e-4) & (magnitude < 1e16), plain)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def padded_id(value: Column) -> Column:
    """Digits become a six-place id; longer numbers and other text stay whole."""
    text = value.cast("string")
    number = F.regexp_replace(text, r"^0+(?=[0-9])", "")
    padded = F.when(F.length(number) < 6, F.lpad(number, 6, "0")).otherwise(number)
    return F.when(text.rlike(r"^[0-9]+$"), padded).otherwise(text)


def bucket_and_key(uri: Column, scheme: str) -> Column:
    """Struct (bucket, key) of an object URI; NULL when the scheme differs."""
    rest = F.regexp_extract(uri, rf"^{scheme}://(.*)$", 1)
    bucket = F.split(rest, "/", 2)
    parts = F.struct(
        F.get(bucket, F.lit(0)).alias("bucket"),
        F.coalesce(F.regexp_replace(F.get(bucket, F.lit(1)), r"^/+", ""), F.lit("")).alias("key"),
    )
    return F.when(uri.startswith(f"{scheme}://"), parts)


def next_cursor(link_header: Column) -> Column:
    """The ``cursor`` query value of the first ``rel="next"`` link that has one."""
    links = F.filter(F.split(link_header, ","), lambda x: x.contains('rel="next"'))
    urls = F.transform(links, lambda x: F.regexp_extract(x, r"<([^>]+)>", 1))
    queries = F.transform(urls, lambda u: F.regexp_extract(u, r"\?([^#]*)", 1))
    values = F.transform(queries, lambda q: F.regexp_extract(q, r"(?:^|&)cursor=([^&]+)", 1))
    return F.try_url_decode(F.get(F.filter(values, lambda v: v != ""), F.lit(0)))


def encoded_id(model_id: Column) -> Column:
    """Percent-encode an id for a URL path and keep its slashes."""
    encoded = F.url_encode(model_id)
    for found, wanted in (("%2F", "/"), ("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def compact_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def iso_time(ts: Column) -> Column:
    """UTC ISO text with an offset; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(
        whole,
        F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )


def batch_path(prefix: str, run_id: Column, partition_id: Column, batch: Column) -> Column:
    return F.format_string(
        prefix + "/run_id=%s/partition_id=%s/batches/batch_%06d.jsonl", run_id, partition_id, batch
    )
