"""Text rules and derivations as column expressions (Q1, Q2, Q3).

Every helper returns a native ``Column`` (regex, string and higher-order
functions), so table jobs stay inside whole-stage code generation; there is
no Python UDF. Patterns are anchored with ``^`` and ``\\z`` to give the
full-match meaning of the reference's checks (``$`` would also match before
a final newline).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's validation patterns (full match unless noted).
# Phone: the reference's class also lists a comma; it is dropped here.
PHONE = r"1[345678][0-9]{9}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
DOUBLE = r"-?[0-9]+\.?[0-9]*"
INT = r"-?[0-9]+[0-9]*"
NUMBER = r"-?[0-9]*\.?[0-9]*"
SCIENTIFIC = r"[+-]*[0-9]+\.?[0-9]*[Ee]*[+-]*[0-9]+"
DIGITS = r"[0-9]+"
LETTER = r"[a-zA-Z]+"
LETTER_OR_NUMERIC = r"[a-zA-Z0-9]+"
LETTER_NUM_UNDERLINE = r"[a-zA-Z0-9_]+"
MD5 = r"[a-fA-F0-9]{32}"
# At least two alphanumerics with single separators from "-|._" between them.
EMAIL = r"[a-z0-9A-Z]([-|._]?[a-z0-9A-Z])+@([a-z0-9A-Z]+(-[a-z0-9A-Z]+)?\.)+[a-zA-Z]{2,}"
# The same languages for Java's backtracking engine: possessive quantifiers and no two
# ways to read a text, so that long words are judged in linear time and constant stack.
LINEAR = {
    EMAIL: r"[a-z0-9A-Z](?:[-|._]?+[a-z0-9A-Z])++@(?:[a-z0-9A-Z]++(?:-[a-z0-9A-Z]++)?+\.)++[a-zA-Z]{2,}+",
    SCIENTIFIC: (r"[+-]*+(?:[0-9]{2,}+|[0-9]++(?:[Ee]++[+-]*+|[+-]++)[0-9]++"
                 r"|[0-9]++\.(?:[0-9]++|[0-9]*+(?:[Ee]++[+-]*+|[+-]++)[0-9]++))"),
    DOUBLE: r"-?+[0-9]++(?:\.[0-9]*+)?+",
    INT: r"-?+[0-9]++",
    NUMBER: r"-?+[0-9]*+(?:\.[0-9]*+)?+",
    DIGITS: r"[0-9]++",
    LETTER: r"[a-zA-Z]++",
    LETTER_OR_NUMERIC: r"[a-zA-Z0-9]++",
    LETTER_NUM_UNDERLINE: r"[a-zA-Z0-9_]++",
}
# Searched (not full match): special characters or control whitespace.
SPECIAL_CHARS = "[`~@$%^&*+=|{}<>/?~！@#￥%……&*——+|{}‘；：”“’。，、？]|\n|\r|\t"
# Java's String.trim strips every char up to U+0020.
JAVA_BLANK = r"[\x00-\x20]"


def full(pattern: str) -> str:
    return rf"^(?:{pattern})\z"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches(c: str | Column, pattern: str) -> Column:
    """Full match; null input does not match."""
    return F.coalesce(_c(c).rlike(full(LINEAR.get(pattern, pattern))), F.lit(False))


def java_trim(c: str | Column) -> Column:
    # btrim: linear, where a pattern anchored at the end is quadratic on inner blanks
    return F.btrim(_c(c), F.lit("".join(map(chr, range(33)))))


def is_empty(c: str | Column) -> Column:
    """Null or only blanks (chars <= U+0020)."""
    return F.coalesce(_c(c).rlike(rf"^{JAVA_BLANK}*+\z"), F.lit(True))


def is_number(c: str | Column) -> Column:
    """Optional minus, digits, at most one dot; '-' and '.' alone count."""
    return matches(c, NUMBER) & (F.length(_c(c)) > 0)


def has_special_char(c: str | Column) -> Column:
    return F.coalesce(_c(c).rlike(SPECIAL_CHARS), F.lit(False))


RULES = {
    "is_empty": is_empty,
    "is_not_empty": lambda c: ~is_empty(c),
    "is_phone": lambda c: matches(c, PHONE),
    "is_date": lambda c: matches(c, DATE),
    "is_double": lambda c: matches(c, DOUBLE),
    "is_int": lambda c: matches(c, INT),
    "is_number": is_number,
    "is_scientific": lambda c: matches(c, SCIENTIFIC),
    "is_digits": lambda c: matches(c, DIGITS),
    "is_letter": lambda c: matches(c, LETTER),
    "is_letter_or_numeric": lambda c: matches(c, LETTER_OR_NUMERIC),
    "is_letter_num_underline": lambda c: matches(c, LETTER_NUM_UNDERLINE),
    "is_email": lambda c: matches(c, EMAIL),
    "is_md5": lambda c: matches(c, MD5),
    "has_special_char": has_special_char,
}


# --- derivations (Q2) --------------------------------------------------------------

def _nonempty(c: Column, value: Column) -> Column:
    """Null for null or empty input (the reference returns null there)."""
    return F.when(c.isNull() | (F.length(c) == 0), F.lit(None)).otherwise(value)


def left(c, n: int) -> Column:
    c = _c(c)
    return _nonempty(c, F.lit("") if n <= 0 else F.substring(c, 1, n))


def right(c, n: int) -> Column:
    c = _c(c)
    return _nonempty(c, F.lit("") if n <= 0 else F.right(c, F.lit(n)))


def substr(c, start: int, end: int) -> Column:
    """0-based, end-exclusive; negative positions count from the end; clipped."""
    c = _c(c)
    n = F.length(c)
    s = F.lit(start) if start >= 0 else F.greatest(n + start, F.lit(0))
    e = F.least(F.lit(end) if end >= 0 else n + end, n)
    return _nonempty(c, F.when(e > s, c.substr(s + 1, e - s)).otherwise(F.lit("")))


def split_part(c, sep_regex: str, i: int) -> Column:
    """Element ``i`` of a regex split, with trailing empty strings removed
    first (so an index into them gives null); null for empty input.

    Splits with a limit of ``i + 2``: element ``i`` is exact and element
    ``i + 1`` is the unsplit rest, so no array of all words is built. An
    empty element ``i`` survives only if the rest holds a non-empty piece.
    """
    c = _c(c)
    arr = F.split(c, sep_regex, i + 2)
    elem = F.get(arr, F.lit(i))
    rest = F.get(arr, F.lit(i + 1))
    rest_has_piece = rest.isNotNull() & ~rest.rlike(rf"^(?:{sep_regex})*\z")
    keep = elem.isNotNull() & ((elem != F.lit("")) | rest_has_piece)
    return _nonempty(c, F.when(keep, elem))


TOKEN = "[a-z_0-9]"


def replace_tokens(c, mapping: dict[str, str]) -> Column:
    """Replace every maximal ``[a-z_0-9]+`` token found in ``mapping``.

    When no replacement value contains a key as a token, one
    ``regexp_replace`` per key with token-boundary lookarounds gives the same
    text as a single left-to-right pass; otherwise the text is cut into
    tokens and gaps and each token is looked up once.
    """
    import re
    c = _c(c)
    keys = set(mapping)
    cascade = any(tok in keys for v in mapping.values() for tok in re.findall(TOKEN + "+", v))
    if not cascade and all(re.fullmatch(TOKEN + "+", k) for k in keys):
        out = c
        for k, v in mapping.items():
            # literal first, so the regex engine can scan for it
            out = F.regexp_replace(out, f"{k}(?<!{TOKEN}{k})(?!{TOKEN})",
                                   v.replace("\\", "\\\\").replace("$", "\\$"))
        return _nonempty(c, out)
    pieces = F.regexp_extract_all(c, F.lit(f"({TOKEN}+|[^a-z_0-9]+)"), F.lit(1))
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    swapped = F.transform(pieces, lambda p: F.coalesce(F.try_element_at(m, p), p))
    return _nonempty(c, F.array_join(swapped, ""))


def escape_quotes(c) -> Column:
    c = _c(c)
    return F.replace(F.replace(c, F.lit('"'), F.lit('\\"')), F.lit("'"), F.lit("\\'"))


def starts_with(c, prefix: str) -> Column:
    c = _c(c)
    return F.coalesce(F.when(F.length(c) > 0, c.startswith(prefix)), F.lit(False)) \
        if prefix else F.lit(False)


def ends_with(c, suffix: str) -> Column:
    c = _c(c)
    return F.coalesce(F.when(F.length(c) > 0, c.endswith(suffix)), F.lit(False)) \
        if suffix else F.lit(False)


def contains(c, part: str) -> Column:
    c = _c(c)
    return F.coalesce(F.when(F.length(c) > 0, c.contains(part)), F.lit(False)) \
        if part else F.lit(False)


def text_len(c) -> Column:
    return F.coalesce(F.length(_c(c)), F.lit(0))


def join_skip_leading_empty(arr: Column, sep: str) -> Column:
    """Join where the separator is only added once the result is non-empty."""
    first = F.array_position(F.transform(arr, lambda x: x != F.lit("")), True)
    return F.when(first == 0, F.lit("")).otherwise(
        F.array_join(F.slice(arr, first, F.size(arr)), sep))


def display_width(c) -> Column:
    """Chars in U+0391..U+FFE5 count 2, others 1; a char outside the BMP
    counts 4 (two UTF-16 units, both in that range)."""
    c = _c(c)
    wide = F.regexp_count(c, F.lit(r"[\u0391-\uFFE5]"))
    astral = F.regexp_count(c, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    return F.length(c) + wide + astral * 3


def display_decimal(x) -> Column:
    return F.format_string("%.3f", _c(x))


def display_format(x) -> Column:
    """Up to three decimals, trailing zeros removed."""
    return F.regexp_replace(F.format_string("%.3f", F.round(_c(x), 3)), r"\.?0+\z", "")


# --- numeric-or-text comparison (Q3) -------------------------------------------------

def _both_numeric(a, b) -> Column:
    return matches(a, DOUBLE) & matches(b, DOUBLE)


def smart_compare(a, b, op: str) -> Column:
    """Compare as numbers when both sides look numeric, else as text."""
    a, b = _c(a), _c(b)
    ops = {
        "eq": lambda x, y: x == y, "gt": lambda x, y: x > y, "lt": lambda x, y: x < y,
        "ge": lambda x, y: x >= y, "le": lambda x, y: x <= y,
    }
    f = ops[op]
    return F.when(_both_numeric(a, b), f(a.cast("double"), b.cast("double"))).otherwise(f(a, b))
