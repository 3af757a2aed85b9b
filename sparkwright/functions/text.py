"""Text measures and rewrites as column expressions; nothing here leaves the JVM.

``\\w``, ``\\d`` and ``\\s`` are spelt out as Unicode classes because Java's
short forms cover ASCII only.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkwright.functions.stopwords import default_stop_words

# The character classes and patterns that define the counts.
# ASCII ranges come first: the class is tested left to right, property look-ups last.
WORD_CHARS = r"a-zA-Z0-9_\p{L}\p{N}"
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
MAIL = rf"[<\[(]?[{WORD_CHARS}][{WORD_CHARS}.-]+@[{WORD_CHARS}.]+[>\])]?[:=]?[0-9]{{0,}}"
URL = (
    r"[<]?https?:\/\/(www\.)?[-a-zA-Z0-9@:,%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b"
    r"([-a-zA-Z0-9()@,:%_\+.~#?&//=]*)[>]?"
)
MENTION = rf"@[{WORD_CHARS}.-]+"
HASHTAG = rf"#[{WORD_CHARS}]+"
TAG = r"<[^>]+>"
NO_MATCH = r"()(?!)"
# MAIL for Java, in linear time: a search can only begin where a run of address characters
# begins, at a bracket, or where the last match ended. Leading dots and dashes of the run are group 1.
MAIL_RUN = (
    rf"(?:\G|(?<![{WORD_CHARS}.-])|(?=[<\[(]))([.-]*+)"
    rf"[<\[(]?[{WORD_CHARS}][{WORD_CHARS}.-]++@[{WORD_CHARS}.]+[>\])]?[:=]?[0-9]{{0,}}"
)
SPECIAL = r"[{.()!:,=/<>?}-]+"
NON_LETTER = rf"[^a-zA-Z{SPACE_CHARS}]+"
# NON_LETTER less the characters of SPECIAL, which part words as blanks do.
GLUED = rf"[^a-z{{.()!:,=/<>?}}{SPACE_CHARS}-]+"
PUNCT = rf"[^{WORD_CHARS}{SPACE_CHARS}]"
DIGIT = r"\p{Nd}"
ALPHA = r"[a-zA-Z]"
SPACES = rf"[{SPACE_CHARS}]+"
NON_SPACE = rf"[^{SPACE_CHARS}]+"
WORDS = rf"[{WORD_CHARS}]+"
WORD_OR_PUNCT = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{SPACE_CHARS}]+"
KEPT_WORD = r"\b[a-z]{4,39}\b"
LONG_RUN = r"[a-z]{4,}"
MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*>.*?(?:</script[^>]*>|\z)"
    r"|style\b[^>]*>.*?(?:</style[^>]*>|\z)|/?[a-z!?][^>]*>)"
)
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}
NAMED_ENTITY = r"&[a-zA-Z][a-zA-Z0-9]*;"
DIGITS_7 = r"\p{Nd}{7,}"


def _base_letters() -> tuple[str, str]:
    """All precomposed letters and, place by place, the letters without their marks."""
    marked, base = [], []
    for code in range(0xC0, 0x1F000):
        letter, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and all(unicodedata.category(m) == "Mn" for m in marks):
            marked.append(chr(code))
            base.append(letter)
    return "".join(marked), "".join(base)


ACCENTED, UNACCENTED = _base_letters()


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hits(c: str | Column, pattern: str) -> Column:
    return F.regexp_count(_c(c), F.lit(pattern)).cast("bigint")


def _drop(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, pattern, to)


def _where_found(c: Column, marks: Iterable[str], change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts that hold one of the marks, the others as they are. The lambda
    names the text, so that it is computed once for the test and the change."""

    def step(t: Column) -> Column:
        found = reduce(or_, [F.contains(t, F.lit(m)) for m in marks])
        return F.when(found, change(t)).otherwise(t)

    return F.transform(F.array(c), step)[0]


def _mail_pattern(raw: Column) -> Column:
    """The mail pattern for texts that can hold an address, a pattern without matches
    for the others: its search starts a scan at every word. The choice sits in the
    pattern argument so that the text expression is not repeated per branch."""
    possible = F.contains(raw, F.lit("@")) | F.contains(raw, F.lit("&#"))
    return F.when(possible, F.lit(MAIL_RUN)).otherwise(F.lit(NO_MATCH))


def collapse_space(c: str | Column) -> Column:
    return F.trim(_drop(_c(c), SPACES, " "))


def truncate_text(c: str | Column, n: int = 25000) -> Column:
    return F.substring(_c(c), 1, n)


def char_count(c: str | Column) -> Column:
    return F.length(_c(c)).cast("bigint")


def split_words(c: str | Column) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(NON_SPACE), F.lit(0))


def word_count(c: str | Column) -> Column:
    return _hits(c, NON_SPACE)


def unique_word_count(c: str | Column) -> Column:
    return F.size(F.array_distinct(split_words(c))).cast("bigint")


def punct_count(c: str | Column) -> Column:
    return _hits(c, PUNCT)


def upper_word_count(c: str | Column) -> Column:
    cased = F.filter(split_words(c), lambda w: (w == F.upper(w)) & (w != F.lower(w)))
    return F.size(cased).cast("bigint")


def lower_word_count(c: str | Column) -> Column:
    cased = F.filter(split_words(c), lambda w: (w == F.lower(w)) & (w != F.upper(w)))
    return F.size(cased).cast("bigint")


def digit_count(c: str | Column) -> Column:
    return _hits(c, DIGIT)


def alpha_count(c: str | Column) -> Column:
    """Letters a-z and A-Z: the length lost when their runs are removed."""
    t = _c(c)
    return (F.length(t) - F.length(_drop(t, ALPHA + "+"))).cast("bigint")


def drop_link_prefixes(c: str | Column) -> Column:
    return F.replace(F.replace(_c(c), F.lit("URL:"), F.lit("")), F.lit("mailto:"), F.lit(""))


def tag_count(c: str | Column) -> Column:
    """Matches of TAG: of the pieces that a ``>`` ends, those whose first ``<`` is not
    their last character."""
    pieces = F.split(drop_link_prefixes(c), ">", -1)
    closed = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    found = F.filter(closed, lambda p: F.instr(p, "<").between(1, F.length(p) - 1))
    return F.size(found).cast("bigint")


def email_count(c: str | Column) -> Column:
    return F.regexp_count(drop_link_prefixes(c), _mail_pattern(_c(c))).cast("bigint")


def url_count(c: str | Column) -> Column:
    return _hits(drop_link_prefixes(c), URL)


def mention_count(c: str | Column) -> Column:
    return _hits(drop_link_prefixes(c), MENTION)


def hashtag_count(c: str | Column) -> Column:
    return _hits(drop_link_prefixes(c), HASHTAG)


# Output column -> measure, in the order of the feature table.
TEXT_MEASURES = {
    "email_counts": email_count,
    "html_tag_counts": tag_count,
    "url_counts": url_count,
    "twitter_username_counts": mention_count,
    "hashtag_counts": hashtag_count,
    "character_counts": char_count,
    "word_counts": word_count,
    "unique_word_counts": unique_word_count,
    "punctuation_mark_counts": punct_count,
    "uppercase_word_counts": upper_word_count,
    "lowercase_word_counts": lower_word_count,
    "digit_counts": digit_count,
    "alphabetic_char_counts": alpha_count,
}


def _ascii_references(c: Column) -> Column:
    """Decode decimal references below 128; others stand for characters that the
    letter filter removes anyway, so they become nothing. The text is cut at its
    references once and each piece brings its number along."""
    pieces = F.split(F.regexp_replace(c, r"&#([0-9]+);", "\u0000$1\u0001"), "\u0000", -1)

    def decode(piece: Column, i: Column) -> Column:
        n = F.substring_index(piece, "\u0001", 1).try_cast("int")
        char = F.when(n.between(1, 127), F.char(n)).when(n == 160, F.lit(" ")).otherwise(F.lit(""))
        rest = F.regexp_replace(piece, "^[0-9]+\u0001", "")
        return F.when(i == 0, piece).otherwise(F.concat(F.coalesce(char, F.lit("")), rest))

    return F.array_join(F.transform(pieces, decode), "")


def _drop_markup(c: Column) -> Column:
    """Remove MARKUP. Behind the last ``>`` no tag can end, so no search begins there:
    its ``<`` are set aside meanwhile. No ``-->`` can follow there either, so a comment
    opened there reaches to the end: the tail is cut at its first ``<!--``."""
    tail = F.substring_index(c, ">", -1)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(tail))
    open_comment = F.substring_index(tail, "<!--", 1)
    held = F.concat(head, F.replace(open_comment, F.lit("<"), F.lit("\u0002")))
    return F.replace(_drop(held, MARKUP), F.lit("\u0002"), F.lit("<"))


def _named_entities(t: Column) -> Column:
    for name, char in ENTITIES.items():
        if name == "&amp;":
            t = F.regexp_replace(t, r"&(?!amp;)[a-zA-Z][a-zA-Z0-9]*;", "")
        t = F.replace(t, F.lit(name), F.lit(char))
    return t


def strip_markup(c: str | Column) -> Column:
    """Visible text of marked-up input: comments, scripts, styles and tags go,
    character references are resolved. An open comment reaches to the end. A step is left
    out for texts without the character it starts at (or the one it sets aside)."""
    t = _where_found(_c(c), ["<", "\u0002"], _drop_markup)
    t = _where_found(t, ["&#", "\u0000"], _ascii_references)
    return _where_found(t, ["&"], _named_entities)


def letters_only(c: str | Column) -> Column:
    """All rewrites up to the point where only lower-case letters, spaces and the
    characters of SPECIAL are left; the latter two part words."""
    t = strip_markup(drop_link_prefixes(c))
    t = _where_found(t, ["@"], lambda x: F.regexp_replace(x, MAIL_RUN, "$1"))
    for mark, pattern in (("://", URL), ("@", MENTION), ("#", HASHTAG)):
        t = _where_found(t, [mark], lambda x, pattern=pattern: _drop(x, pattern))
    return _drop(F.lower(t), GLUED)


def clean_tokens(c: str | Column, stop_words: Iterable[str] | None = None) -> Column:
    """Words of 4 to 39 letters that are not stop words, in text order."""
    stop = list(default_stop_words() if stop_words is None else stop_words)
    runs = F.regexp_extract_all(letters_only(c), F.lit(LONG_RUN), F.lit(0))

    def kept(w: Column) -> Column:
        short = F.length(w) < 40
        return short & ~w.isin(stop) if stop else short

    return F.filter(runs, kept)


def clean_text(c: str | Column, stop_words: Iterable[str] | None = None) -> Column:
    return F.array_join(clean_tokens(c, stop_words), " ")


def strip_accents(c: str | Column) -> Column:
    """Letters without their marks, written as one character or as letter and marks."""
    return F.regexp_replace(F.translate(_c(c), ACCENTED, UNACCENTED), r"\p{Mn}+", "")


def word_tokens(c: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(WORDS), F.lit(0))


def punct_tokens(c: str | Column) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(WORD_OR_PUNCT), F.lit(0))


def redact_pii(c: str | Column) -> Column:
    """Mask mail addresses, then digit runs of seven or more."""
    return _drop(_drop(_c(c), MAIL_RUN, "$1[MAIL]"), DIGITS_7, "[NUMBER]")
