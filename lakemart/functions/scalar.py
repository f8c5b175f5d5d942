"""Column expressions: text clean-up, dates, decimals, flags, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURE = "decimal(38,18)"

# Exchange suffix of a security or index code -> exchange name.
EXCHANGE_BY_SUFFIX = {".SH": "SSE", ".SZ": "SZSE", ".BJ": "BSE"}
# Spellings of an open trading day.
OPEN_DAY_VALUES = ("1", "true", "t", "y", "yes")
# Fixed value: cycle ids are this prefix followed by YYYYMMDD.
CYCLE_PREFIX = "CYCLE_"

EIGHT_DIGITS = r"^[0-9]{8}$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    text = F.trim(_column(value).cast("string"))
    return F.when(text != "", text)


def strict_date(value: Column | str) -> Column:
    """YYYYMMDD text to date; anything else non-blank raises.

    Years start at 0001.  The digits are cast as ISO text, which takes a fraction of the time of parsing by a pattern.
    """
    text = clean_text(value)
    known = text.rlike(EIGHT_DIGITS) & (F.length(text) == 8) & (text >= "0001")
    iso = F.overlay(F.overlay(text, F.lit("-"), 7, 0), F.lit("-"), 5, 0)
    return (
        F.when(text.isNull() | known, iso)
        .otherwise(F.raise_error(F.concat(F.lit("not a YYYYMMDD date: "), text)))
        .cast("date")
    )


def lenient_date(value: Column | str) -> Column:
    """ISO or YYYYMMDD text to date; anything else is NULL."""
    text = clean_text(value)
    return F.when(text.rlike(ISO_DATE), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike(EIGHT_DIGITS), F.try_to_date(text, "yyyyMMdd")
    )


def strict_measure(value: Column | str) -> Column:
    """Text to decimal(38,18); unparsable text raises."""
    text = _column(value).cast("string")
    return F.when(F.trim(text) != "", text).cast(MEASURE)


def lenient_measure(value: Column | str) -> Column:
    """Text to decimal(38,18); unparsable text is NULL."""
    return _column(value).cast("string").try_cast(MEASURE)


def lenient_int(value: Column | str) -> Column:
    """Text to integer, rounding a fraction half away from zero; unparsable text is NULL."""
    return F.round(_column(value).cast("string").try_cast("decimal(38,6)")).try_cast("int")


def tri_state(value: Column | str) -> Column:
    """'1' is true, '0' is false, anything else is NULL."""
    text = clean_text(value)
    return F.when(text == "1", F.lit(True)).when(text == "0", F.lit(False))


def is_listed(value: Column | str) -> Column:
    return F.upper(F.trim(_column(value).cast("string"))) == "L"


def is_open_day(value: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(_column(value).cast("string"))).isin(*OPEN_DAY_VALUES), F.lit(False))


def exchange_of(code: Column | str) -> Column:
    upper = F.upper(_column(code))
    expression = F.lit(None).cast("string")
    for suffix, exchange in EXCHANGE_BY_SUFFIX.items():
        expression = F.when(upper.endswith(suffix), exchange).otherwise(expression)
    return expression


def labelled(*parts: str | Column) -> Column:
    """Text pieces and columns glued together, a NULL column counting as ''."""
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    )


def glue(*parts: Column) -> Column:
    """Concatenation that skips NULL parts."""
    return F.concat_ws("", *parts)


def row_hash(*parts: Column) -> Column:
    """md5 over the pipe-joined non-NULL parts."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def present_labels(labels: dict[str, Column], separator: str = "+") -> Column:
    """Names of the components whose run id is present, in order."""
    return F.concat_ws(separator, *[F.when(run.isNotNull(), F.lit(name)) for name, run in labels.items()])


def present_runs(labels: dict[str, Column], separator: str = "|") -> Column:
    """``name=run`` of the components whose run id is present, in order."""
    return F.concat_ws(
        separator,
        *[F.when(run.isNotNull(), F.concat(F.lit(name + "="), run)) for name, run in labels.items()],
    )


def latest_of(times: Sequence[Column], fallback: Column) -> Column:
    """Greatest of several times, each NULL replaced by the fallback."""
    return F.greatest(*[F.coalesce(t, fallback) for t in times])


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def guarded_change_pct(now: Column, before: Column) -> Column:
    """(now - before) / before as double; NULL where before is NULL or zero."""
    return F.when(
        F.coalesce(before, F.lit(0).cast("double")).cast("double") != 0,
        (now - before).cast("double") / before.cast("double"),
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def one_day_return(pct: Column, close: Column, pre_close: Column, pct_unit: float = 100.0) -> Column:
    """Stated percentage change over its unit, else computed from the two closes."""
    return F.coalesce(pct.cast("double") / F.lit(pct_unit), safe_ratio(close - pre_close, pre_close))


def cycle_id_of(day: Column | str) -> Column:
    return F.concat(F.lit(CYCLE_PREFIX), F.date_format(_column(day), "yyyyMMdd"))


def cycle_date_of(cycle_id: Column | str) -> Column:
    """Date of a well-formed cycle id, else NULL."""
    text = _column(cycle_id)
    return F.when(
        text.rlike("^" + CYCLE_PREFIX + "[0-9]{8}$"),
        F.try_to_date(F.substring(text, len(CYCLE_PREFIX) + 1, 8), "yyyyMMdd"),
    )


def is_quarter_end(day: Column) -> Column:
    return F.month(day).isin(3, 6, 9, 12)


def scope_key(request_hash: Column, run_id: Column) -> Column:
    return F.coalesce(F.nullif(request_hash, F.lit("")), run_id)


def request_hash(*params: Column) -> Column:
    """Stable hash of the request parameters of an artifact."""
    return F.sha2(F.to_json(F.struct(*params)), 256)
