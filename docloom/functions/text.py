"""Text functions as Spark columns, with the semantics of Python's text functions where the two differ.

Patterns carry ``(?U)``: then white space, digits and word boundaries follow Unicode, which Java's defaults do not.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docloom.functions import patterns as P
from docloom.functions.batches import pieces

SPACE = r"[\s\x1c-\x1f]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """White space of any kind removed from both ends (Spark's trim knows U+0020 only)."""
    return F.regexp_replace(col(c), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def rstrip(c) -> Column:
    return F.regexp_replace(col(c), rf"(?U){SPACE}+\z", "")


def first_non_empty(*cs) -> Column:
    """The first value that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in cs), F.lit(""))


def split_lines(c) -> Column:
    """Lines as Python's splitlines gives them: all line ends count, no empty line after the last."""
    parts = F.split(col(c), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def extract_all(c, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))


def distinct_in_order(values: Column) -> Column:
    return F.array_distinct(values)


def codes(c, pattern: str = P.CODE) -> Column:
    """Distinct codes by first appearance, white space inside a code removed."""
    return F.array_distinct(F.transform(extract_all(c, pattern), lambda x: F.regexp_replace(x, rf"(?U){SPACE}", "")))


def amounts(c, pattern: str = P.AMOUNT) -> Column:
    """Distinct amounts with their unit; commas and inner white space removed."""
    return F.array_distinct(F.transform(extract_all(c, pattern), lambda x: F.regexp_replace(x, rf"(?U)[,\s]", "")))


def document_names(c, pattern: str = P.DOCUMENT) -> Column:
    return F.array_distinct(extract_all(c, pattern))


def content_hash(c, digits: int = 16) -> Column:
    """Hex SHA-256 of the text with white space collapsed and stripped, shortened."""
    return F.substring(F.sha2(F.trim(F.regexp_replace(col(c), rf"(?U){SPACE}+", " ")), 256), 1, digits)


# fixed ranges of characters that stay as they are and do not compose with what stands before them, beside those up to U+02FF
_COMPOSED = (
    r"\x{370}-\x{373}\x{375}-\x{37d}\x{388}-\x{482}\x{48a}-\x{58f}\x{5d0}-\x{5ea}\x{620}-\x{64a}\x{e01}-\x{e37}\x{10a0}-\x{10ff}\x{1e00}-\x{1eff}\x{2002}-\x{205f}\x{20a0}-\x{20bf}\x{2150}-\x{218b}\x{2190}-\x{2328}\x{2460}-\x{27ff}"
    r"\x{3000}-\x{3029}\x{3041}-\x{3096}\x{30a1}-\x{30ff}\x{3131}-\x{318e}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}\x{ff01}-\x{ff9d}\x{1f300}-\x{1faff}"
)
_OPEN = rf"[^\x00-\x{{2ff}}](?<![{_COMPOSED}])"


@F.arrow_udf(StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    done = [pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.slice(at, n).to_pylist()], pa.string()) for at, n in pieces(texts)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def nfc(c) -> Column:
    """Unicode's composed form. Spark has no builtin, so an Arrow function does it; as Spark gives such a function every row, whatever condition
    stands around it, texts that are seen to be composed are null to it."""
    c = col(c)
    return F.when(c.rlike(_OPEN), _nfc(F.when(c.rlike(_OPEN), c))).otherwise(c)


def collapse_repeats(c, letters: str = P.REPEATED) -> Column:
    """Runs of one letter of a class become one letter."""
    return F.regexp_replace(col(c), rf"({letters})\1+", "$1")


def match_key(c, noise: str = P.NOISE, repeated: str | None = P.REPEATED) -> Column:
    """The form in which texts are compared: composed, without white space and punctuation, repeats collapsed."""
    out = F.regexp_replace(nfc(c), noise, "")
    return collapse_repeats(out, repeated) if repeated else out


def snippets(c, width: int, step: int = 8) -> Column:
    """Windows of ``width`` characters every ``step``; none when the text is shorter."""
    c = col(c)
    last = F.length(c) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda i: F.substring(c, i + 1, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def integer(digits: Column) -> Column:
    """A run of digits of any script as a number; null for none and for more than 18."""
    plain = F.translate(digits, "".join(map(chr, range(0xFF10, 0xFF1A))), "0123456789")
    return F.try_to_number(F.nullif(plain, F.lit("")), F.lit("999999999999999999")).cast("long")


def first_integer(c) -> Column:
    """The first run of digits as a number, else null."""
    return integer(F.regexp_extract(col(c), r"(?U)\d+", 0))


def page_marker(c) -> Column:
    """The number after "p." or null."""
    return integer(F.regexp_extract(col(c), r"(?U)p\.\s*(\d+)", 1))


def after_last(c, mark: str) -> Column:
    """What follows the last ``mark``, the whole text without one."""
    return F.substring_index(col(c), mark, -1)


def count_matches(c, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))


def kind_before(c, mark: str = ":") -> Column:
    return F.substring_index(col(c), mark, 1)


def parent_of(code) -> Column:
    """The code before " (", trimmed."""
    return strip(F.substring_index(col(code), " (", 1))


def sub_of(code) -> Column:
    """What stands in the parentheses of "code (sub)", else null."""
    c = col(code)
    inside = F.substring(c, F.instr(c, "(") + 1, F.length(c))
    return F.when(F.contains(c, F.lit(" (")), strip(F.rtrim(inside, F.lit(")"))))


def full_code(base, subtype) -> Column:
    """"base", or "base (subtype)" where the subtype says more."""
    base, sub = F.coalesce(col(base), F.lit("")), strip(F.coalesce(col(subtype), F.lit("")))
    return F.when((sub != "") & (sub != base), F.concat(base, F.lit(" ("), sub, F.lit(")"))).otherwise(base)


def with_tag(source, tag) -> Column:
    """"source (tag)", or the tag alone without a source."""
    source, tag = col(source), col(tag)
    return F.when(source == "", tag).otherwise(F.concat(source, F.lit(" ("), tag, F.lit(")")))


def labelled_sections(sections: list[tuple[str, Column]], gap: str = "\n\n") -> Column:
    """Non-empty sections, each under its label."""
    return F.concat_ws(gap, *(F.when(body != "", F.concat(F.lit(label + "\n"), body)) for label, body in sections))


def page_tag(previous, page, near: int = 3) -> Column:
    """"p. lo~hi" when the previous page is another one at most ``near`` away, else "p. n"."""
    a, b = col(previous), col(page)
    span = F.concat(F.lit("p. "), F.least(a, b).cast("string"), F.lit("~"), F.greatest(a, b).cast("string"))
    return F.when(a.isNotNull() & (a != 0) & (a != b) & (F.abs(a - b) <= near), span).otherwise(F.concat(F.lit("p. "), b.cast("string")))
