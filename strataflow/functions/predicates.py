"""Row predicates written by administrators, admitted by a whitelist (no subquery, aggregate or window).

A filter can't fail on a row: a division by zero, a cast or a comparison that makes no sense
is unknown for that row, and whole numbers in sums and products are taken as doubles, which don't
overflow.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.schema import CATALOGUE_COLUMNS, STRING_COLUMNS

# Words and functions a filter text may use besides column names.
KEYWORDS = frozenset(
    "and or not is null between in like true false case when then else end cast try_cast as "
    "bigint int double string boolean date timestamp".split()
)
FUNCTIONS = frozenset(
    "abs ceil coalesce concat floor greatest if ifnull initcap least length lower lpad ltrim mod nullif "
    "regexp_like replace round rpad rtrim sign split_part startswith endswith contains substring trim upper "
    "try_cast cast".split()
)

# Of these, the ones that take numbers.
NUMERIC_FUNCTIONS = ("abs", "ceil", "floor", "mod", "round", "sign")

_TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|''|\\.)*')|(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"
    r"|(?P<word>[A-Za-z_][A-Za-z_0-9]*)|(?P<mark><=>|<=|>=|<>|!=|==|\|\||[=<>+\-*/%(),]))"
)
_COMPARISONS = {"=", "==", "<>", "!=", "<", "<=", ">", ">=", "<=>"}


class FilterTextError(ValueError):
    """The filter text uses something that filters may not use."""


def _tokens(text: str) -> list[tuple[str, str]]:
    found, at = [], 0
    stripped = text.rstrip()
    while at < len(stripped):
        match = _TOKEN.match(stripped, at)
        if match is None:
            raise FilterTextError(f"unexpected character at {at} in filter: {text!r}")
        found.append((match.lastgroup, match.group(match.lastgroup)))
        at = match.end()
    return found


def _check(tokens: list[tuple[str, str]], columns: set[str]) -> None:
    for i, (kind, token) in enumerate(tokens):
        if kind != "word":
            continue
        word = token.lower()
        called = i + 1 < len(tokens) and tokens[i + 1][1] == "("
        if word in columns and not called:
            continue
        if word in KEYWORDS and (not called or word in {"and", "or", "not", "in", "when", "then", "else", "between"}):
            continue
        if called and word in FUNCTIONS:
            continue
        raise FilterTextError(f"{token!r} is not allowed in a filter")


def _is_word(token: tuple[str, str], *words: str) -> bool:
    return token[0] == "word" and token[1].lower() in words


def _signed(tokens: list[tuple[str, str]], i: int) -> bool:
    """Whether a plus or minus is a sign, not an operator."""
    if i == 0:
        return True
    kind, before = tokens[i - 1]
    return (kind == "mark" and before != ")") or (kind == "word" and before.lower() in KEYWORDS - {"end", "null", "true", "false"})


def _join_signs(tokens: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Signs become a part of the number after them."""
    out: list[tuple[str, str]] = []
    i = 0
    while i < len(tokens):
        if tokens[i][1] in "+-" and i + 1 < len(tokens) and tokens[i + 1][0] == "number" and _signed(tokens, i):
            out.append(("number", ("-" if tokens[i][1] == "-" else "") + tokens[i + 1][1]))
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def _operand_end(tokens: list[tuple[str, str]], i: int) -> int:
    """Place after the operand that starts here: a value, a call, a group or a CASE."""
    if tokens[i][1] in "+-":
        return _operand_end(tokens, i + 1)
    opened, closed = ("case", "end") if _is_word(tokens[i], "case") else ("(", ")")
    if opened == "(" and tokens[i][1] != "(":
        if i + 1 >= len(tokens) or tokens[i + 1][1] != "(":
            return i + 1
        i += 1
    depth = 0
    for j in range(i, len(tokens)):
        depth += (tokens[j][1].lower() == opened) - (tokens[j][1].lower() == closed)
        if depth == 0:
            return j + 1
    return len(tokens)


def _safe_values(tokens: list[tuple[str, str]], columns: set[str]) -> list[str]:
    """Texts of the tokens, so that no row can raise an error.

    Numbers compared with a text column become text, as ``stratum_1 = 8507`` would fail to
    cast; text columns compared with numbers or used in sums are cast or unknown.
    """
    out = [token for _, token in tokens]

    def text_column(i: int) -> bool:
        return 0 <= i < len(tokens) and _is_word(tokens[i], *STRING_COLUMNS)

    def operator(i: int) -> bool:
        return 0 <= i < len(tokens) and tokens[i][0] == "mark" and tokens[i][1] in ("+", "-", "*", "/", "%")

    def number_like(i: int) -> bool:
        """A column of numbers or a whole expression of them."""
        return 0 <= i < len(tokens) and tokens[i][0] == "word" and tokens[i][1].lower() in columns and not text_column(i)

    def quote(i: int) -> None:
        if 0 <= i < len(tokens) and tokens[i][0] == "number":
            out[i] = f"'{tokens[i][1]}'"

    for i, (kind, token) in enumerate(tokens):
        if operator(i - 1) or operator(i + 1):
            if text_column(i):
                out[i] = f"try_cast({token} AS double)"
            elif number_like(i):
                out[i] = f"cast({token} AS double)"
            elif kind == "number":
                out[i] = f"{token}D"
        elif text_column(i) and i and tokens[i - 1][1] == "(" and i > 1 and _is_word(tokens[i - 2], *NUMERIC_FUNCTIONS):
            out[i] = f"try_cast({token} AS double)"
        elif text_column(i) and (
            (i > 1 and tokens[i - 1][1] in _COMPARISONS and number_like(i - 2) and not operator(i - 3))
            or (i + 2 < len(tokens) and tokens[i + 1][1] in _COMPARISONS and number_like(i + 2))
        ):
            out[i] = f"try_cast({token} AS double)"
        elif token in _COMPARISONS:
            if text_column(i - 1) and not operator(i - 2):
                quote(i + 1)
            if text_column(i + 1) and not operator(i + 2):
                quote(i - 1)
        elif _is_word(tokens[i], "in", "between"):
            start = i - 2 if i and _is_word(tokens[i - 1], "not") else i - 1
            if not text_column(start) or operator(start - 1):
                continue
            if token.lower() == "between":
                quote(i + 1)
                quote(i + 3)
            else:
                for j in range(i + 1, len(tokens)):
                    quote(j)
                    if tokens[j][1] == ")":
                        break
        elif _is_word(tokens[i], "cast", "mod") and i + 1 < len(tokens) and tokens[i + 1][1] == "(":
            out[i] = f"try_{token}"
    for i in range(len(tokens) - 1, -1, -1):
        if tokens[i][1] in ("/", "%") and i + 1 < len(tokens):
            end = _operand_end(tokens, i + 1)
            out[i + 1] = f"nullif({out[i + 1]}"
            out[end - 1] = f"{out[end - 1]}, 0)"
    return out


def tokens_of(text: str, columns: list[str] = CATALOGUE_COLUMNS) -> list[tuple[str, str]]:
    """Kinds and texts of the tokens of an admitted filter text."""
    tokens = _join_signs(_tokens(text))
    _check(tokens, {c.lower() for c in columns})
    return tokens


def compile_predicate(text: str | None, columns: list[str] = CATALOGUE_COLUMNS) -> Column:
    """Boolean column of a filter text; an empty text lets every row pass."""
    if text is None or not text.strip():
        return F.lit(True)
    return F.expr(" ".join(_safe_values(tokens_of(text, columns), {c.lower() for c in columns})))
