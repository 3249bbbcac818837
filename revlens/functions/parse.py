"""Column -> Column parsing functions for review and catalog fields.

All are built-in Spark expressions (code-generated, null-safe, no Python
UDF).  Spark 4 runs with ANSI mode on: ``getItem(0)`` on an empty array
raises, so element access goes through ``F.get`` (NULL when out of range),
and text -> number goes through ``try_cast`` (NULL on bad text).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The patterns and nested types the reference's fields follow.
YEAR_PATTERN = r"\d{4}"            # first four-digit run of a text date
DIGITS_PATTERN = r"\d+"            # every digit run of "[helpful, total]"
ASIN_PATTERN = r"[A-Z0-9]{10}"     # a product id inside related-list text
CATEGORIES_TYPE = "array<array<string>>"
SALES_RANK_TYPE = "map<string,double>"
RELATED_TYPE = "map<string,array<string>>"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_year(review_time: ColumnOrName) -> Column:
    """first 4-digit run of a text date as int; NULL when absent."""
    return F.regexp_substr(_col(review_time), F.lit(YEAR_PATTERN)).try_cast("int")


def digit_runs(text: ColumnOrName) -> Column:
    """All digit runs of a text as array<string>."""
    return F.regexp_extract_all(_col(text), F.lit(DIGITS_PATTERN), F.lit(0))


def helpful_votes(helpful: ColumnOrName) -> Column:
    """F2 item 0: helpful votes out of ``"[h, t]"``; NULL when missing."""
    return F.get(digit_runs(helpful), 0).try_cast("int")


def total_votes(helpful: ColumnOrName) -> Column:
    """F2 item 1: total votes out of ``"[h, t]"``; NULL when missing."""
    return F.get(digit_runs(helpful), 1).try_cast("int")


def related_ids(related: ColumnOrName) -> Column:
    """every 10-char product id in a related-list text, in text order
    (non-overlapping, as a regex scan finds them)."""
    return F.regexp_extract_all(_col(related), F.lit(ASIN_PATTERN), F.lit(0))


# The tokens of a Python literal.  Strings take a prefix and one
# or three quotes; any other character is a token of its own, which no JSON
# reader takes.
_PREFIX = "[uUbBrR]{0,2}"
_STRING = _PREFIX + "(?:" + "|".join((
    r"'{3}(?:[^\\']++|\\.|'(?!''))*+'{3}", r'"{3}(?:[^\\"]++|\\.|"(?!""))*+"{3}',
    r"'(?:[^\\'\n]++|\\.)*+'", r'"(?:[^\\"\n]++|\\.)*+"')) + ")"
_NUMBER = r"[-+]?(?:0[xX][0-9a-fA-F_]+|(?:\d[\d_]*+\.?[\d_]*+|\.\d[\d_]*+)(?:[eE][-+]?\d+)?)[lL]?(?![\w.])"
LITERAL_TOKEN = rf"(?s){_STRING}|{_NUMBER}|[A-Za-z_]\w*+|\S"
NAMES = {"None": "null", "True": "true", "False": "false"}

#: Text with none of these reads the same as JSON and as a Python literal.
_PYTHON_ONLY = r"[\\(+]|null|true|false"


def _after_even_backslashes(text: Column, pattern: str, becomes: str) -> Column:
    """Replace ``pattern`` where the backslashes before it pair up."""
    return F.regexp_replace(text, F.lit(rf"(?s)(?<!\\)((?:\\\\)*+){pattern}"), F.lit(f"$1{becomes}"))


def _string_body(token: Column) -> Column:
    """A string token's text, escaped for JSON, without quotes."""
    body = F.regexp_replace(token, F.lit(rf"(?s)^{_PREFIX}('{{3}}|\"{{3}}|'|\")(.*)\1$"), F.lit("$2"))
    escaped = body
    for pattern, becomes in (
            (r"\\x([0-9A-Fa-f]{2})", r"\\u00$2"), (r"\\\n", ""), (r"\\a", r"\\u0007"), (r"\\v", r"\\u000b"),
            (r"\\0(?![0-7])", r"\\u0000"), (r"\\([0-3]?[0-7]{1,2})", r"\\?$2"), (r"\\'", "'"), (r'"', r'\\"'),
            (r"\\([^\\\"bfnrtu?])", r"\\\\$2")):
        escaped = _after_even_backslashes(escaped, pattern, becomes)
    raw = F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    plain = F.when(body.contains('"'), F.replace(body, F.lit('"'), F.lit('\\"'))).otherwise(body)
    is_raw = token.rlike("^[uUbB]?[rR]")
    return F.when(~body.contains("\\"), plain).when(is_raw, raw).otherwise(escaped)


def _number(token: Column) -> Column:
    digits = F.regexp_replace(token, F.lit("[_lL]|^[+]"), F.lit(""))
    hexed = F.conv(F.regexp_replace(digits, F.lit("0[xX]"), F.lit("")), 16, 10)
    # JSON wants digits on both sides of the point.
    dotted = F.regexp_replace(F.regexp_replace(digits, F.lit(r"^(-?)\."), F.lit("$10.")), F.lit(r"\.(?!\d)"), F.lit(".0"))
    return F.when(digits.rlike("0[xX]"), hexed).otherwise(dotted)


def _json_token(tokens: Column, token: Column, i: Column) -> Column:
    """What a token becomes in JSON, by its neighbours."""
    def text(t: Column) -> Column:
        return (F.length(t) > 1) & (t.endswith("'") | t.endswith('"'))

    before, after = F.coalesce(F.get(tokens, i - 1), F.lit("")), F.coalesce(F.get(tokens, i + 1), F.lit(""))
    quote = F.lit('"')
    # Strings next to each other are one string.
    string = F.concat(F.when(text(before), F.lit("")).otherwise(quote), _string_body(token),
                      F.when(text(after), F.lit("")).otherwise(quote))
    number = F.when(after == ":", F.concat(quote, _number(token), quote)).otherwise(_number(token))
    # One value in parentheses without a comma is no tuple.
    atom_next = (after != "") & ~after.rlike(r"^[\[\](){},:]$")
    opens_one = atom_next & (F.get(tokens, i + 2) == ")")
    closes_one = (F.get(tokens, i - 2) == "(") & ~before.rlike(r"^[\[\](){},:]$")
    out = F.when(text(token), string)
    out = out.when((token == ",") & after.isin("]", ")", "}") & ~before.isin("[", "(", "{", ",", ":", ""), F.lit(""))
    out = out.when(token == "(", F.when(opens_one, F.lit("")).otherwise(F.lit("[")))
    out = out.when(token == ")", F.when(closes_one, F.lit("")).otherwise(F.lit("]")))
    for name, becomes in NAMES.items():
        out = out.when(token == name, F.lit(f" {becomes}"))
    return out.when(token.rlike(rf"^{_NUMBER}$"), F.concat(F.lit(" "), number)).when(token.rlike(r"^\w"), F.lit("@")).otherwise(token)


def literal_to_json(text: ColumnOrName) -> Column:
    """Python literal -> JSON text: strings with prefixes, one or three quotes,
    escapes and neighbours that join; tuples; trailing commas; None, True,
    False; whole, long, hexadecimal and fractional numbers.  Text that is no
    literal becomes text that is no JSON.  Not taken: octal and \\N or \\U
    escapes, complex numbers, sets; parentheses around one list or tuple count
    as a tuple of one."""
    found = F.regexp_extract_all(_col(text), F.lit(LITERAL_TOKEN), F.lit(0))
    # The outer list makes the tokens a variable: they are found once.
    return F.get(F.transform(F.array(found), lambda tokens: F.array_join(
        F.transform(tokens, lambda token, i: _json_token(tokens, token, i)), "")), F.lit(0))


def _parsed(text: ColumnOrName, kind: str) -> Column:
    c = _col(text)

    def read(json: Column) -> Column:
        # As a field of an object, so that text after the literal is no JSON.
        whole = F.concat(F.lit('{"v": '), json, F.lit("}"))
        return F.from_json(whole, f"struct<v: {kind}>", {"allowUnquotedControlChars": "true"})["v"]

    plain = F.when(~c.rlike(_PYTHON_ONLY), read(c))
    return F.coalesce(plain, F.when(c.isNotNull(), read(literal_to_json(c))))


def parse_categories(text: ColumnOrName) -> Column:
    """Python-literal list of lists -> array<array<string>>; text that is no
    literal gives NULL."""
    return _parsed(text, CATEGORIES_TYPE)


def parse_sales_rank(text: ColumnOrName) -> Column:
    """``{'Cat': 12}`` -> map<string,double>, keys in text order; whole ranks
    are exact to 2^53."""
    return _parsed(text, SALES_RANK_TYPE)


def parse_related(text: ColumnOrName) -> Column:
    """``{'also_viewed': [...], ...}`` -> map<string,array<string>>."""
    return _parsed(text, RELATED_TYPE)


def first_category(categories: ColumnOrName) -> Column:
    """F4/F5 core: element [0][0] of array<array<string>>; NULL if absent."""
    return F.get(F.get(_col(categories), 0), 0)


def first_category_or_null(categories: ColumnOrName) -> Column:
    """element [0][0] with '' turned into NULL."""
    return F.nullif(first_category(categories), F.lit(""))


def first_key(m: ColumnOrName) -> Column:
    """first key of a map (text order); NULL for NULL or empty maps."""
    return F.get(F.map_keys(_col(m)), 0)


def first_value(m: ColumnOrName) -> Column:
    """first value of a map; NULL for NULL or empty maps."""
    return F.get(F.map_values(_col(m)), 0)


def map_field(m: ColumnOrName, key: str) -> Column:
    """F8: map lookup; a missing key gives NULL."""
    return F.try_element_at(_col(m), F.lit(key))


def size_or_null(arr: ColumnOrName) -> Column:
    """array size when positive, else NULL (empty and NULL arrays; a
    NULL array's size is -1 when ANSI mode is off)."""
    n = F.size(_col(arr))
    return F.when(n > 0, n)


def title_tokens(title: ColumnOrName) -> Column:
    """F11 + F12: lower-case, split on one space; empty tokens are kept."""
    return F.split(F.lower(_col(title)), " ")


def missing_text(c: ColumnOrName) -> Column:
    """NULL or empty text."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def clean_number(c: ColumnOrName, to: str = "double") -> Column:
    """Text -> number with NaN folded into NULL (Spark NaN is not NULL and
    would poison averages)."""
    v = _col(c).try_cast(to)
    if to in ("double", "float"):
        v = F.when(F.isnan(v), F.lit(None).cast(to)).otherwise(v)
    return v
