"""Text helpers as pure ``Column`` expressions (JVM-side, inside whole-stage codegen).

Dialect notes that matter for parity:
* ``pg_concat`` skips NULL arguments (PostgreSQL CONCAT); ``strict_concat`` returns NULL
  when any argument is NULL (MariaDB CONCAT and the ``||`` operator).
* ``regex_extract_or_null`` returns NULL on no match.  Java regex alternation is
  leftmost-first, POSIX is leftmost-longest: write alternatives longest first.
* ``transliterate`` spells text in ASCII with a table by code point, built from Unicode
  decomposition and names plus the fixed spellings below, so no per-row Python runs.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.util import to_col

# --- fixed values --------------------------------------------------------------------
# ASCII spellings that Unicode's decomposition does not give.
LATIN_SPELLINGS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th", "Ø": "O", "ø": "o",
    "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Ð": "D", "ð": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ŀ": "l", "Ŀ": "L",
    "Ŋ": "NG", "ŋ": "ng", "ĸ": "k", "Ŧ": "T", "ŧ": "t", "ƒ": "f", "ə": "e", "ɛ": "e",
}
PUNCTUATION_SPELLINGS = {
    "¡": "!", "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "«": "<<", "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-",
    "°": "deg", "±": "+-", "´": "'", "¶": "P", "·": "*", "¸": ",", "»": ">>", "¿": "?", "×": "x", "÷": "/",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‖": "||", "‘": "'", "’": "'", "‚": ",", "‛": "'",
    "“": '"', "”": '"', "„": ",,", "‟": '"', "†": "+", "‡": "++", "•": "*", "‧": ".", "‰": "%0", "′": "'", "″": "''",
    "‹": "<", "›": ">", "⁄": "/", "−": "-", "∕": "/", "、": ",", "。": ".", "・": "*", "「": "[", "」": "]", "ー": "-",
}
CURRENCY_SPELLINGS = {
    "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "₡": "CRC", "₤": "L.", "₦": "N", "₧": "Pts", "₩": "W", "₪": "NS",
    "₫": "D", "€": "EUR", "₭": "K", "₮": "T", "₱": "P", "₲": "G", "₴": "UAH", "₹": "Rs", "₺": "TL", "₽": "R", "₿": "BTC",
}
# Lower-case letters; capitals follow with a capital first letter.
GREEK_SPELLINGS = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC_SPELLINGS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ђ": "dj", "є": "ie", "ѕ": "dz", "і": "i", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "џ": "dzh", "ґ": "g",
}
# Control characters deleted by the special-character cleaner.
CONTROL_CHARS_PATTERN = r"[\x00-\x1F\x7F]"
# Characters kept by the text normaliser after upper-casing.
NORMALIZED_KEEP_PATTERN = r"[^A-Z0-9 ]"
# --------------------------------------------------------------------------------------

# Code points with an entry of their own: all scripts up to the kana, then compatibility forms.
_TABLE_RANGES = ((0x0080, 0x3100), (0xF900, 0x10000))
_SEPARATOR = "\x1f"                         # between entries of the table; none holds a control character


def _capital(spelling: str) -> str:
    return spelling[:1].upper() + spelling[1:]


@lru_cache(maxsize=1)
def _fixed_spellings() -> dict[str, str]:
    out = LATIN_SPELLINGS | PUNCTUATION_SPELLINGS | CURRENCY_SPELLINGS
    for letters in (GREEK_SPELLINGS, CYRILLIC_SPELLINGS):
        out |= letters | {k.upper(): _capital(v) for k, v in letters.items() if len(k.upper()) == 1 and k.upper() not in letters}
    return out


def spelling(ch: str) -> str:
    """ASCII spelling of a character: a fixed one, the name of a kana, or that of its parts; marks
    that combine with a letter are dropped, and so is what has none (other scripts, symbols)."""
    if ch.isascii():
        return ch
    fixed = _fixed_spellings()
    if ch in fixed:
        return fixed[ch]
    kind = unicodedata.category(ch)
    if kind.startswith("Z"):
        return " "
    if kind.startswith(("M", "C")):
        return ""
    name = unicodedata.name(ch, "")
    if name.startswith(("HIRAGANA LETTER ", "KATAKANA LETTER ")):
        return name.split()[-1].lower()
    parts = unicodedata.normalize("NFKD", ch)
    # a mark that stands alone decomposes into a blank and the mark: nothing is left of it
    return "" if parts == ch or parts.startswith(" ") else "".join(map(spelling, parts))


@lru_cache(maxsize=1)
def translit_table() -> tuple[str, str, str]:
    """(characters, their one-character spellings) for ``F.translate``, and the spellings of all
    table code points, joined."""
    src, dst, every = [], [], []
    for lo, hi in _TABLE_RANGES:
        for cp in range(lo, hi):
            to = spelling(chr(cp)) if not 0xD800 <= cp < 0xE000 else ""
            every.append(to)
            if len(to) == 1 and cp < 0x2000:
                src.append(chr(cp))
                dst.append(to)
    return "".join(src), "".join(dst), _SEPARATOR.join(every)


def transliterate(c) -> Column:
    """Text in ASCII: accented Latin letters, combining marks, Greek, Cyrillic, kana, punctuation,
    currency and compatibility forms are spelled, other characters dropped.

    Letters with a single ASCII letter are translated at once; only text that is still not ASCII
    after that is looked up character by character.
    """
    src, dst, every = translit_table()
    (lo, hi), (lo2, _) = _TABLE_RANGES
    table = F.split(F.lit(every), _SEPARATOR)            # folded into an array literal by the optimizer

    def spelled(ch: Column) -> Column:
        cp = F.ascii(ch)
        at = F.when(cp < hi, cp - (lo - 1)).when(cp >= lo2, cp - (lo2 - (hi - lo) - 1))
        return F.when(cp < lo, ch).otherwise(F.coalesce(F.try_element_at(table, at), F.lit("")))

    col = F.translate(to_col(c), src, dst)
    return (F.when(~col.rlike(r"[^\x00-\x7F]"), col)
            .otherwise(F.array_join(F.transform(F.split(col, ""), spelled), "")))


def pg_concat(*cols) -> Column:
    """PostgreSQL ``CONCAT``: NULL arguments are skipped."""
    return F.concat_ws("", *[to_col(c) for c in cols])


def strict_concat(*cols) -> Column:
    """MariaDB ``CONCAT`` / SQL ``||``: NULL if any argument is NULL."""
    return F.concat(*[to_col(c) for c in cols])


def trim_spaces(c) -> Column:
    """SQL ``TRIM``: removes blanks (U+0020) only."""
    return F.trim(to_col(c))


@lru_cache(maxsize=1)
def unicode_whitespace() -> str:
    """Every character Python's ``str.isspace`` accepts (what pandas ``str.strip``
    removes), derived by rule."""
    return "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip_whitespace(c) -> Column:
    """pandas ``str.strip``: removes every Unicode whitespace at both ends (``btrim``
    with that character set; no regex)."""
    return F.btrim(to_col(c), F.lit(unicode_whitespace()))


def blank_to_null(c) -> Column:
    """``NULLIF(trim(c), '')``."""
    return F.nullif(trim_spaces(c), F.lit(""))


def left(c, n: int) -> Column:
    """``LEFT(s, n)`` / Python ``s[:n]`` (characters, not bytes)."""
    return F.substring(to_col(c), 1, n)


def regex_extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """``SUBSTRING(s FROM re)``: capture group, NULL when there is no match."""
    col = to_col(c)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def clean_special(c) -> Column:
    """Transliterate to ASCII, then delete ASCII control characters. NULL stays NULL."""
    return F.regexp_replace(transliterate(F.coalesce(to_col(c).cast("string"))),
                            CONTROL_CHARS_PATTERN, "")


def normalize_text(c, length: int | None = 255) -> Column:
    """Cut to ``length`` first (``None``: whole text), strip, transliterate, upper, keep
    ``[A-Z0-9 ]``, collapse blanks; an empty result becomes NULL."""
    cut = to_col(c).cast("string")
    if length is not None:
        cut = F.substring(cut, 1, length)
    s = strip_whitespace(cut)
    s = F.upper(transliterate(s))
    s = F.regexp_replace(s, NORMALIZED_KEEP_PATTERN, "")
    s = F.trim(F.regexp_replace(s, " +", " "))
    return F.nullif(s, F.lit(""))


def upper_trim(c) -> Column:
    return F.upper(F.trim(to_col(c)))
