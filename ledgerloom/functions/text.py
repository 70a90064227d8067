"""Text normalization as column expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode (and Python's str.strip) counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_OTHER_SPACE = WHITESPACE.replace(" ", "")
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def clean_text(col: Column) -> Column:
    """Trim every kind of whitespace; blank and missing both become null."""
    return F.nullif(F.btrim(col.cast("string"), F.lit(WHITESPACE)), F.lit(""))


def collapse_spaces(col: Column) -> Column:
    """Every run of whitespace becomes one space. Single spaces, by far the most, are left untouched."""
    spaces = F.translate(col, _OTHER_SPACE, " " * len(_OTHER_SPACE))
    return F.regexp_replace(spaces, " {2,}", " ")


def title_case(col: Column) -> Column:
    """Capitalize every run of cased letters (`quezon-city o'neil` -> `Quezon-City O'Neil`).

    `initcap` alone only restarts at spaces, so it is applied to each run.
    """
    runs = F.regexp_extract_all(col, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def python_repr(raw: Column) -> Column:
    """Quoted source text for a reason message; null (blank in CSV) shows as ''."""
    text = F.coalesce(raw, F.lit(""))
    single = F.contains(text, F.lit("'"))
    both = single & F.contains(text, F.lit('"'))
    quote = F.when(single & ~both, F.lit('"')).otherwise(F.lit("'"))
    body = text
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(plain), F.lit(escaped))
    body = F.replace(body, F.lit("'"), F.when(both, F.lit("\\'")).otherwise(F.lit("'")))
    return F.concat(quote, body, quote)
