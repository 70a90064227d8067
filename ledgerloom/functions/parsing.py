"""Strict text -> timestamp / number conversion.

Spark's casts accept more than ISO-8601 and plain decimal text (`T10:00` is today, `1d` is 1.0), so
each cast sits behind a format guard. Unparseable text becomes null, never an error. Every step uses
its input once or twice, which keeps the generated code small enough to compile.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import WHITESPACE

# The accepted formats. Each pair rewrites an ISO-8601 spelling the cast does not know.
_ISO_SPELLINGS = (
    (r"^([0-9]{4})(?:([0-9]{2})([0-9]{2})|([/. ])([0-9]{1,2})\4([0-9]{1,2}))(?=$|[T ])", "$1-$2$5-$3$6"),  # 20250105, 2025/01/05
    (r"([T ][0-9]{2})([0-9]{2})([0-9]{2})(?=$|[ .Z+-])", "$1:$2:$3"),           # T100000
    (r"([T ][0-9]{2})([0-9]{2})(?=$|[ Z+-])", "$1:$2"),                         # T1000
    (r"([T ][0-9]{1,2})(?= ?[Z+-])", "$1:00"),                                  # T10Z
    (r"([T ][0-9]{1,2}:[0-9]{1,2})(?= ?[Z+-])", "$1:00"),                       # T10:00Z
)
# Years a nanosecond timestamp can hold; the two partial years at the ends only with a padded date.
_YEAR = r"(167[89]|16[89][0-9]|1[7-9][0-9]{2}|2[01][0-9]{2}|22[0-5][0-9]|226[01])"
_EDGE_DATE = r"1677-(09-(2[2-9]|30)|1[0-2]-[0-9]{2})|2262-(0[1-3]-[0-9]{2}|04-(0[0-9]|1[01]))"
_TIME = r"[T ][0-9]{1,2}(:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]*)?( ?(Z|[+-][0-9]{1,2}(:?[0-9]{2})?))?)?)?"
# The usual spelling without white space around it, which the cast reads as it is.
_ISO_USUAL = (
    rf"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?)?)?\z"
)
_ISO = rf"^({_YEAR}(-[0-9]{{1,2}}(-[0-9]{{1,2}}({_TIME})?)?)?|({_EDGE_DATE})({_TIME})?)$"
_EXPONENT = r"[eE][+-]?[0-9]+"
_NUMBER = rf"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)({_EXPONENT})?$"
_INFINITY = r"^[+-]?(?i:inf(inity)?)$"


def parse_utc(col: Column) -> Column:
    """ISO-8601 text -> UTC instant; a naive value is UTC; anything else is null.

    `now` and `today` are not ISO-8601 and count as unreadable, as do offsets beyond 18 hours.
    """
    raw = col.cast("string")
    other = F.btrim(raw, F.lit(WHITESPACE))
    for spelling, extended in _ISO_SPELLINGS:
        other = F.regexp_replace(other, spelling, extended)
    # What is not ISO-8601 comes out as empty text. The chain of rewritings is named once, so it is run once.
    rewritten = F.regexp_extract(other, _ISO, 0).try_cast("timestamp")
    return F.when(F.rlike(raw, F.lit(_ISO_USUAL)), raw.try_cast("timestamp")).otherwise(rewritten)


def parse_number(col: Column) -> Column:
    """Decimal text -> double; non-numeric, NaN and overflowing text is null, spelled-out infinity stays."""
    text = F.btrim(col.cast("string"), F.lit(WHITESPACE))
    number = text.try_cast("double")
    finite = F.rlike(text, F.lit(_NUMBER)) & (F.abs(number) < float("inf"))
    return F.when(finite | F.rlike(text, F.lit(_INFINITY)), number)
