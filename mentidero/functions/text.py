"""Text normalisation and features."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mentidero.functions.arrow import give_back

TEXTS = 64  # normalized at a time

# --- fixed values ------------------------------------------------------------------------------
# What a Python `str` method counts as white space: as characters, and as a regex class body under
# the (?U) flag, where \s is Unicode white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"\s\x1c-\x1f"
TOMBSTONES = ("[deleted]", "[removed]")
URL_PATTERN = rf"(?U)http[^{BLANK}]+"
# Signs kept in cleaned (already lower-case) text. Listed one by one: the JVM turns such a class into
# a bit set, ranges into a chain of tests.
KEPT_SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789?!.,'’"
MIN_RAW_LENGTH = 2
MIN_CLEAN_LENGTH = 3
# --- end of fixed values -----------------------------------------------------------------------


def normalized(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """NFKC of each text. Few texts at a time are Python strings, whose code points may take four bytes each; what a
    batch leaves behind is returned to the system."""
    for whole in batches:
        parts = [pa.array([], pa.string())]
        for begin in range(0, len(whole), TEXTS):
            texts = whole.slice(begin, TEXTS).to_pylist()
            parts.append(pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts], pa.string()))
        yield pa.concat_arrays(parts)
        del whole, parts
        give_back()


_nfkc = F.arrow_udf(normalized, StringType())


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Pure ASCII text is a fixed point, so only other texts cross to Python."""
    foreign = F.when(F.octet_length(text) != F.length(text), text)
    return F.coalesce(_nfkc(foreign), text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_tombstone(body: Column) -> Column:
    return body.isin(*TOMBSTONES)


def word_count(text: Column) -> Column:
    """Runs of non-blank characters; 0 for blank text, null for null."""
    pieces = F.size(F.split(text, f"(?U)[{BLANK}]+"))
    # A blank at either end leaves an empty piece there.
    ends = text.rlike(f"(?U)^[{BLANK}]").cast("int") + F.right(text, F.lit(1)).rlike(f"(?U)[{BLANK}]").cast("int")
    return F.when(text == "", F.lit(0)).when(text.isNotNull(), pieces - ends)


def text_features(text: Column) -> dict[str, Column]:
    return {
        "text_len": F.length(text),
        "word_count": word_count(text),
        "has_exclamation": F.contains(text, F.lit("!")),
        "has_question": F.contains(text, F.lit("?")),
    }


def clean_text(text: Column) -> Column:
    """Lower case, no URLs, only basic letters, digits and ?!.,'’, single spaces between."""
    no_urls = F.regexp_replace(F.lower(text), URL_PATTERN, "")
    return F.trim(F.regexp_replace(no_urls, f"[^{KEPT_SIGNS}]+", " "))
