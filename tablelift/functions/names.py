"""Clean-up of column names, for header lists and for columns that hold names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters that are folded to plain ones, the mark a broken encoding leaves for
# the letter n-tilde (alone or doubled), and what counts as white space. Other marks are dropped.
ACCENTED = "ñÑáÁéÉíÍóÓúÚ"
PLAIN = "nnaaeeiioouu"
BROKEN = "\ufffd"
NOT_ASCII = r"[^\x00-\x7F]"
SPACE_RUN = r"(?U)[\s\x1C-\x1F]+"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)

_fold = str.maketrans(ACCENTED, PLAIN)


def clean_name(name: str) -> str:
    """The tidy form of one header: trimmed, plain ASCII, lower case, ``_`` for white space."""
    folded = re.sub(BROKEN + "{1,2}", "n", name.strip()).translate(_fold)
    return re.sub(NOT_ASCII, "", re.sub(r"\s+", "_", folded)).lower()


def standardize_name(name: Column) -> Column:
    """:func:`clean_name` as a column expression, without a Python worker."""
    trimmed = F.btrim(name, F.lit(SPACES))
    mended = F.replace(F.replace(trimmed, F.lit(BROKEN * 2), F.lit("n")), F.lit(BROKEN), F.lit("n"))
    folded = _join_words(F.translate(mended, ACCENTED, PLAIN))
    # Most names are plain ASCII and skip the folding.
    plain = F.octet_length(trimmed) == F.char_length(trimmed)
    return F.lower(F.when(plain, _join_words(trimmed)).otherwise(F.regexp_replace(folded, NOT_ASCII, "")))


def _join_words(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, "_")
