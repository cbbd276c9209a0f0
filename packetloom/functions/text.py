"""Expressions for messy field text.

The functions take the SQL text of a string expression, most often a quoted
column name, and return a Column. They are written as SQL because a frame has
dozens of text columns: one expression is one call to the JVM, and Catalyst
compiles it with the rest of the stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "no value", compared in lower case after trimming.
MISSING_WORDS = ["", "nan", "none", "null", "na", "n/a", "<nan>"]
# The category that stands for a missing value.
MISSING_CATEGORY = "__MISSING__"
# Words read as numbers, and label words that mean "not an attack".
TRUE_WORDS = ["true", "yes"]
FALSE_WORDS = ["false", "no"]
BENIGN_WORDS = ["0", "normal", "benign", "false"]

# What counts as white space around a value; trim() alone only cuts blanks.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DECIMAL_PATTERN = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
HEX_PATTERN = "^0x[0-9a-fA-F]+$"


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_of(name: str) -> str:
    """A column of any type as SQL text of its string form."""
    return f"cast({quoted(name)} AS string)"


def literal(text: str) -> str:
    """A string literal as SQL text."""
    return "'" + "".join(c if c.isalnum() or c in " _-./:|" else f"\\u{ord(c):04x}" for c in text) + "'"


def words(values: list[str]) -> str:
    return "(" + ", ".join(literal(v) for v in values) + ")"


# ------------------------------------------------------------------ SQL texts


def strip_sql(e: str) -> str:
    return f"trim(BOTH {literal(WHITESPACE)} FROM {e})"


def strip_column_sql(e: str) -> str:
    """Strip the text of a column; text without white space at its ends is left alone, which is much cheaper."""
    ends = [f"ascii({e})", f"ascii(right({e}, 1))"]
    return f"if({' AND '.join(f'{c} > 32 AND {c} < 128' for c in ends)}, {e}, {strip_sql(e)})"


def missing_sql(e: str) -> str:
    return missing_stripped_sql(e, strip_sql(e))


def missing_stripped_sql(e: str, stripped: str) -> str:
    longest = max(map(len, MISSING_WORDS))
    return f"({e} IS NULL OR (octet_length({stripped}) <= {longest} AND lower({stripped}) IN {words(MISSING_WORDS)}))"


def present_sql(e: str) -> str:
    return f"CASE WHEN NOT {missing_sql(e)} THEN {e} END"


def first_value_sql(e: str) -> str:
    def head(separator: str) -> str:
        return f"WHEN contains({e}, '{separator}') THEN {strip_sql(f'substring_index({e}, {literal(separator)}, 1)')}"

    return f"CASE {head('|')} {head(';')} ELSE {e} END"


def finite_sql(e: str) -> str:
    """Number of decimal text; digits beyond the range of a double are no number."""
    return f"nullif(nullif(try_cast({e} AS double), double('infinity')), double('-infinity'))"


def hex_sql(e: str) -> str:
    """Value of 0x... text of any length, rounded once.

    15 digits fit a bigint. Digits after them only decide how the last bit
    rounds, for which it is enough to know whether one of them is not zero.
    """
    digits = f"ltrim('0', substr({e}, 3))"
    head = f"coalesce(cast(conv(substr({digits}, 1, 15), 16, 10) AS bigint), 0L)"
    tail = f"substr({digits}, 16)"
    sticky = f"{head} | if(rtrim('0', {tail}) != '', 1L, 0L)"
    return f"nullif(cast({sticky} AS double) * pow(16, length({tail})), double('infinity'))"


def short_lower_sql(e: str) -> str:
    """Lower case of a text that is short enough to be one of the words, else null."""
    longest = max(len(w) for w in [*TRUE_WORDS, *FALSE_WORDS, *INFINITY_WORDS])
    return f"if(octet_length({e}) <= {longest}, lower({e}), NULL)"


def number_sql(head: str, lowered: str, missing: str) -> str:
    """Number of a first value, given its short lower case and whether the whole text is missing.

    Null stands for "not a number"; NaN never leaves this expression, because
    Spark sorts NaN above every number. The first character tells most texts
    apart before a pattern is tried: 43 to 57 are the signs, the point and the digits.
    """
    return f"""CASE
        WHEN {missing} THEN NULL
        WHEN ascii({head}) BETWEEN 43 AND 57 AND {head} RLIKE '{DECIMAL_PATTERN}' THEN {finite_sql(head)}
        WHEN startswith({head}, '0x') AND {head} RLIKE '{HEX_PATTERN}' THEN {hex_sql(head)}
        WHEN {lowered} IN {words(TRUE_WORDS)} THEN 1D
        WHEN {lowered} IN {words(FALSE_WORDS)} THEN 0D
        WHEN {lowered} IN {words(INFINITY_WORDS)} THEN try_cast({lowered} AS double)
        END"""


def category_sql(e: str) -> str:
    return f"CASE WHEN {missing_sql(e)} THEN '{MISSING_CATEGORY}' ELSE {strip_sql(e)} END"


# -------------------------------------------------------------------- columns


def is_missing(e: str) -> Column:
    """True for null and for every missing word; never null itself."""
    return F.expr(missing_sql(e))


def first_value(e: str) -> Column:
    """First entry of a repeated field: a pipe splits before a semicolon does."""
    return F.expr(first_value_sql(e))


def parse_numeric(e: str) -> Column:
    """Number in messy text, or null: missing words, repeats, words, hex, decimals, infinities.

    For many columns, operators.typing does the same in steps that share work.
    """
    head = first_value_sql(strip_sql(e))
    return F.expr(number_sql(head, short_lower_sql(head), missing_sql(e)))


def boolean_word(e: str) -> Column:
    """1.0 or 0.0 for yes/no words, null for all other text."""
    word = f"lower({strip_sql(e)})"
    return F.expr(f"CASE WHEN {word} IN {words(TRUE_WORDS)} THEN 1D WHEN {word} IN {words(FALSE_WORDS)} THEN 0D END")


def clean_category(e: str) -> Column:
    """Trimmed text, or one word for everything that is missing."""
    return F.expr(category_sql(e))


def is_attack_word(e: str) -> Column:
    """1 unless the text is one of the benign words. Null text is no benign word, so it is 1."""
    return F.expr(f"if(coalesce(lower({strip_sql(e)}) IN {words(BENIGN_WORDS)}, false), 0, 1)")


def safe_name(c: Column) -> Column:
    """Text usable as a file name: runs of other characters become one underscore."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_.-]+", "_")


def joined(c: Column, separator: str = "|") -> Column:
    return F.array_join(c, separator)


def text_or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))
