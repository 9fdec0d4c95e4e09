"""Text rules as Column expressions. All stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware classes, written out because Java's \s and \w are ASCII only.
# Both are valid in Java and in RE2.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
SPACE_IN = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WORD_IN = r"\p{L}\p{N}_"
DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"

# The same characters one by one.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Latin-1 characters a cleaner leaves as they are. A class of single Latin-1 characters is
# one table look-up per character, far cheaper than the Unicode classes above, and most
# text needs nothing else.
_TIDY = [chr(i) for i in range(0x20, 0x100) if chr(i).isprintable()]

TAG = r"<[^>]+>"
SCRIPT_BLOCK = r"(?s)<script\b.*?</script>"
STYLE_BLOCK = r"(?s)<style\b.*?</style>"

# Characters the strict cleaner keeps besides word characters and spaces.
KEPT_MARKS = r""".,;:()\-+@#%$€£¥&*°'"/\\"""


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once. For long expressions over arrays, which
    are interpreted and would otherwise compute it again at each mention."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _made_of(c: Column, chars) -> Column:
    return c.rlike(f"^[{''.join(re.escape(x) for x in chars)}]*+\\z")


def _only(c: Column, chars) -> Column:
    """The text has none but these characters and no two spaces in a row."""
    return _made_of(c, chars) & ~c.contains("  ")


def _untagged(c: Column, by: str = "") -> Column:
    return F.when(c.contains("<"), F.regexp_replace(c, TAG, by)).otherwise(c)


def strip(c: Column) -> Column:
    """Drop leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Every whitespace run to one space, none at the ends."""
    return F.when(_only(c, _TIDY), F.trim(c)).otherwise(F.trim(F.regexp_replace(c, f"{SPACE}+", " ")))


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def filled(c: Column) -> Column:
    """NULL for a value that is missing or only whitespace, else the stripped value."""
    return F.nullif(strip(c), F.lit(""))


def clean_ws(c: Column) -> Column:
    return collapse(blank(c))


def clean_tags_space(c: Column) -> Column:
    """Tags become one space."""
    return collapse(_untagged(blank(c), " "))


def clean_tags(c: Column) -> Column:
    """Tags vanish."""
    return collapse(_untagged(blank(c)))


def clean_strict(c: Column) -> Column:
    """Tags vanish, then every character outside the allow-list.

    Once tags are gone no script, style or comment delimiter can be left, so script
    bodies stay as text; use ``strip_markup`` first where they must go.
    """
    kept = [x for x in _TIDY if x.isalnum() or x in "_ " or x in KEPT_MARKS]
    text = F.regexp_replace(_untagged(blank(c)), f"[^{WORD_IN}{SPACE_IN}{KEPT_MARKS}]", "")

    def squeezed(t):
        return F.trim(F.regexp_replace(t, f"{SPACE}+", " "))

    lines = _made_of(c, [*kept, "\t", "\n", "\r"])
    return F.when(_only(c, kept), F.trim(c)).when(lines, squeezed(c)).otherwise(squeezed(text))


def strip_markup(c: Column) -> Column:
    """Whole script and style blocks vanish, then the remaining tags."""
    c = F.regexp_replace(blank(c), SCRIPT_BLOCK, "")
    c = F.regexp_replace(c, STYLE_BLOCK, "")
    return F.regexp_replace(c, TAG, "")


def strip_phrases(c: Column, phrases) -> Column:
    """Remove literal phrases one after the other, then clean again."""
    for p in phrases:
        c = F.replace(c, F.lit(p), F.lit(""))
    return clean_strict(c)


def title_case(c: Column) -> Column:
    """A capital at the start of every letter run, also after digits and marks."""
    # initcap starts words at spaces only: mark the other starts with a private character
    # and a space, and take both out again
    mark = "\ue000 "
    marked = F.regexp_replace(c, r"(?<=[^\p{L} ])(?=\p{L})", mark)
    return F.replace(F.initcap(marked), F.lit(mark), F.lit(""))


def normalize_key(c: Column) -> Column:
    """Specification key: word characters, spaces and hyphens only, stripped, lower case."""
    return F.lower(strip(F.regexp_replace(c, f"[^{WORD_IN}{SPACE_IN}-]", "")))


def ellipsize(c: Column, n: int = 500) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def canonical_json(c: Column) -> Column:
    """A JSON object written compactly with keys in their order; any other text unchanged."""
    return F.coalesce(F.to_json(F.from_json(c, "map<string,variant>")), c)


def has_digit(c: Column) -> Column:
    return c.rlike(DIGIT)


def holds_any(c: Column, words) -> Column:
    """True if the text contains one of the literal words.

    One pattern for longer lists: the text is then computed once, also inside array
    functions, which are interpreted.
    """
    if len(words) > 3:
        return c.rlike("|".join(re.escape(w) for w in words))
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out
