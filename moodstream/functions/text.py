"""Text cleaning as native column expressions (no Python UDFs).

The patterns use no look-around, and no back-reference except in
``normalize_arabic``'s elongation rule. White space always means Python's:
the Unicode White_Space set and U+001C..U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tweet-cleaning chain, applied in this order:
#   dots: a dot followed by a non-word character or the end is removed
#         (only the last dot of a run followed by a word character stays)
#   "\x89Û_" -> " ", "&amp" -> " ", newline -> " ", "#" -> "",
#   "@name" -> "@", "http(s)..." -> "www", lower-case, collapse whitespace.
DOT_RUN = r"\.+([^\pL\pN_]|$)"
MOJIBAKE = "\u0089Û_"
AMP = "&amp"
MENTION_ASCII = r"@[a-zA-Z0-9_]+"
URL = r"(?U)https?[^\s\x{1C}-\x{1F}]+"
WHITESPACE = r"(?U)[\s\x{1C}-\x{1F}]+"

# Fixed values of the Arabic normaliser: the special tokens that replace
# URLs and user mentions, the tashkeel range U+064B..U+0652, tatweel U+0640,
# and elongation (a non-digit repeated 3+ times) collapsed to two.
URL_TOKEN = "[رابط]"
USER_TOKEN = "[مستخدم]"
TASHKEEL_TATWEEL = r"[\x{064B}-\x{0652}\x{0640}]"
ARABIC_URL = r"(?U)(?:https?://|www\.)[^\s\x{1C}-\x{1F}]+"
ARABIC_MENTION = r"(?U)@[^\s\x{1C}-\x{1F}]+"
ELONGATION = r"(\D)\1{2,}"

# Python's str.strip() whitespace; Java's (?U)\s is the Unicode White_Space set.
PY_SPACE = r"(?U)[\s\x{1C}-\x{1F}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Unicode-aware strip, like Python's ``str.strip()`` (``trim`` only
    removes ASCII spaces and would keep e.g. NBSP)."""
    return F.regexp_replace(_c(col), rf"^{PY_SPACE}+|{PY_SPACE}+$", "")


def is_blank(col) -> Column:
    """Empty or only whitespace (anchored match: stops at the first
    non-space character instead of rewriting the whole text)."""
    return _c(col).rlike(rf"^{PY_SPACE}*$")


def clean_text(col) -> Column:
    """The tweet cleaning chain, in order, as regexp_replace steps."""
    c = _c(col)
    c = F.regexp_replace(c, DOT_RUN, "$1")
    c = F.replace(c, F.lit(MOJIBAKE), F.lit(" "))
    c = F.replace(c, F.lit(AMP), F.lit(" "))
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    c = F.replace(c, F.lit("#"), F.lit(""))
    c = F.regexp_replace(c, MENTION_ASCII, "@")
    c = F.regexp_replace(c, URL, "www")
    c = F.lower(c)
    c = F.regexp_replace(c, WHITESPACE, " ")
    return F.trim(c)  # only plain spaces are left


def normalize_arabic(col) -> Column:
    """Arabic normaliser for serving and training alike: drop tashkeel and
    tatweel, URLs and mentions to special tokens, collapse elongation,
    strip."""
    c = _c(col)
    c = F.regexp_replace(c, ARABIC_URL, URL_TOKEN)
    c = F.regexp_replace(c, ARABIC_MENTION, USER_TOKEN)
    c = F.regexp_replace(c, TASHKEEL_TATWEEL, "")
    c = F.regexp_replace(c, ELONGATION, "$1$1")
    return py_strip(c)


def token_ids(col, max_len: int = 120) -> Column:
    """A simple token-id scheme: code points of the first ``max_len``
    characters, padded with 0 to exactly ``max_len``. The text is cut before
    it is split into characters."""
    chars = F.filter(F.split(F.left(_c(col), F.lit(max_len)), ""), lambda ch: ch != F.lit(""))
    return pad_tokens(F.transform(chars, lambda ch: F.ascii(ch)), max_len)


def pad_tokens(ids, max_len: int = 120) -> Column:
    """Truncate or right-pad token ids with 0 to exactly ``max_len``."""
    padded = F.concat(_c(ids), F.array_repeat(F.lit(0), F.lit(max_len)))
    return F.slice(padded, 1, max_len)


def attention_mask(padded_ids) -> Column:
    return F.transform(_c(padded_ids), lambda x: (x != 0).cast("int"))


def percent(col) -> Column:
    """A share as a whole percentage, like ``33%``."""
    return F.concat(F.bround(_c(col) * 100, 0).cast("long").cast("string"), F.lit("%"))
