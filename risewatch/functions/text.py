r"""Text columns: link text, match text, words, terms.

Two facts shape the patterns here.  A *word character* is a Unicode letter,
number or underscore, which is narrower than Java's ``(?U)\w`` (that one also
takes combining marks); and a *boundary* lies between a word character and
anything else.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Schemes whose last path segment may carry ;parameters.
PARAM_SCHEMES = [
    "", "ftp", "hdl", "prospero", "http", "https", "imap", "itms", "rtsp", "rtsps", "rtspu", "sip",
    "sips", "mms", "sftp", "tel",
]

# Fixed value: what counts as a term when looking for emerging ones.
TERM_PATTERN = r"\b[A-Za-z][A-Za-z0-9.+#\-]{1,}\b"

# Fixed value: letters that equal i, i, s, k when case is ignored but survive lower-casing.
FOLDED = "\u0130\u0131\u017f\u212a"

_SCHEME = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?"
_HOST = r"(?://([^/?#]*))?"
_LINK = rf"(?s){_SCHEME}{_HOST}([^?#]*).*$"
_LINK_NO_PARAMS = rf"(?s){_SCHEME}{_HOST}((?:[^?#]*/)?[^?#;/]*).*$"


def url_text(url: Column | str) -> Column:
    """Host and path of a link with ``- _ . /`` turned into blanks.

    Port and user stay; query, fragment and ``;parameters`` go.  A link without
    a scheme is all path.  Empty, null and malformed links give ``''``.
    """
    url = F.col(url) if isinstance(url, str) else url
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    has_params = url.contains(";") & F.lower(F.regexp_extract(clean, _LINK, 1)).isin(PARAM_SCHEMES)
    host_path = F.when(
        has_params, F.regexp_replace(clean, _LINK_NO_PARAMS, "$2 $3")
    ).otherwise(F.regexp_replace(clean, _LINK, "$2 $3"))
    host = F.regexp_extract(clean, _LINK, 2)
    malformed = (url.contains("[") | url.contains("]")) & (host.contains("[") != host.contains("]"))
    return F.when(url.isNull() | (url == "") | malformed, F.lit("")).otherwise(
        F.translate(host_path, "-_./", "    ")
    )


def match_text(title: Column | str, url: Column | str | None = None) -> Column:
    """The text keywords are looked for in: the title, then the link's text."""
    title = F.col(title) if isinstance(title, str) else title
    title = F.coalesce(title, F.lit(""))
    if url is None:
        return title
    url = F.col(url) if isinstance(url, str) else url
    return F.when(
        F.length(url) > 0, F.concat(title, F.lit(" "), url_text(url))
    ).otherwise(title)


def words(text: Column | str) -> Column:
    """Maximal runs of word characters, lower-cased, in order.

    The letters in :data:`FOLDED` are replaced first, so that comparing words is
    the same as comparing without regard to case.  A text with a byte for each
    character is ASCII and holds none of them, so no pattern looks for them there.
    """
    text = F.col(text) if isinstance(text, str) else text
    folded = F.when(
        (F.octet_length(text) != F.char_length(text)) & text.rlike(f"[{FOLDED}]"),
        F.translate(text, FOLDED, "iisk"),
    ).otherwise(text)
    return F.regexp_extract_all(F.lower(folded), F.lit(f"{WORD}+"), F.lit(0))


def sql_text(text: str) -> str:
    """A text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spark_pattern(pattern: str) -> str:
    r"""A pattern written with ``\b`` as a case-insensitive Unicode one for ``rlike``."""
    return "(?iU)" + pattern.replace(r"\b", BOUNDARY)


def whole_word_pattern(name: str) -> str:
    """``rlike`` pattern for ``name`` between two boundaries.

    The boundary after a symbol asks for a word character *behind* it, so
    ``C++`` is found in "C++20" but not in "C++ 20".
    """
    before = rf"(?<!{WORD})" if re.match(r"\w", name[0]) else rf"(?<={WORD})"
    after = rf"(?!{WORD})" if re.match(r"\w", name[-1]) else rf"(?={WORD})"
    return "(?iU)" + before + re.escape(name) + after


def term_tokens(text: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case term candidates in order, without stop words (repeats kept)."""
    text = F.col(text) if isinstance(text, str) else text
    # a candidate starts on a letter, so the opening boundary only looks back
    pattern = rf"(?<!{WORD})" + TERM_PATTERN.removeprefix(r"\b").replace(r"\b", BOUNDARY)
    tokens = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    if not stop_words:
        return tokens
    stop = list(stop_words)
    return F.filter(tokens, lambda token: ~token.isin(stop))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours joined by a blank."""
    following = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, F.array_compact(pairs))
