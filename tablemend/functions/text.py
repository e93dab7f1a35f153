"""Text repair expressions. Patterns are Java regular expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def gsub(col: Column, pattern: str, replacement: str) -> Column:
    """Replace every match; ``.`` also matches line breaks, groups are ``$1``."""
    return F.regexp_replace(col, f"(?s){pattern}", replacement)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """The captured group of the first match, or NULL where the pattern does not occur."""
    return F.get(F.regexp_extract_all(col, F.lit(f"(?s){pattern}"), group), 0)


def extract_or_self(col: Column, pattern: str, group: int = 1) -> Column:
    """The captured group of the first match, or the text itself where the pattern does not occur.

    One replacement of the whole text, so the input expression is used once and
    chains of these do not grow.
    """
    return F.regexp_replace(col, f"(?s)^.*?(?:{pattern}).*$", f"${group}")


def if_changed(new: Column, old: Column) -> Column:
    """NULL where a rewrite left the text as it was."""
    return F.nullif(new, old)


def squish(col: Column) -> Column:
    """Trim, and turn every run of Unicode white space into one blank."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def pad_left(col: Column, width: int, fill: str = "0") -> Column:
    """Pad to ``width``; longer values are kept whole."""
    return F.when(F.length(col) < width, F.lpad(col, width, fill)).otherwise(col)


def strip_non_alnum(col: Column, replacement: str = "") -> Column:
    """Replace every character that is neither letter nor digit in any script."""
    return F.regexp_replace(col, r"(?U)[^\p{Alnum}]", replacement)


def lower_tail(col: Column, head: str, tail: str) -> Column:
    """Lower-case the end of the text that matches ``tail`` right after ``head``."""
    whole = f"(?s)^(.*{head})({tail})$"
    changed = F.concat(F.regexp_extract(col, whole, 1), F.lower(F.regexp_extract(col, whole, 2)))
    return F.when(col.rlike(whole), changed).otherwise(col)


def remove_first(col: Column, part: Column) -> Column:
    """Remove the first occurrence of another column's text, taken literally."""
    at = F.position(part, col)
    rest = F.concat(
        F.substring(col, F.lit(1), at - 1),
        F.substring(col, at + F.length(part), F.length(col)),
    )
    return F.when((at > 0) & (F.length(part) > 0), rest).otherwise(col)


# The Greek alphabet as symbol, spelled-out word and Latin letter.
GREEK = [
    ("α", "alpha", "a"),
    ("β", "beta", "b"),
    ("γ", "gamma", "g"),
    ("δ", "delta", "d"),
    ("ε", "epsilon", "e"),
    ("ζ", "zeta", "z"),
    ("η", "eta", "h"),
    ("θ", "theta", "q"),
    ("ι", "iota", "i"),
    ("κ", "kappa", "k"),
    ("λ", "lambda", "l"),
    ("μ", "mu", "m"),
    ("ν", "nu", "n"),
    ("ξ", "xi", "x"),
    ("ο", "omicron", "o"),
    ("π", "pi", "p"),
    ("ρ", "rho", "r"),
    ("σ", "sigma", "s"),
    ("τ", "tau", "t"),
    ("υ", "upsilon", "u"),
    ("φ", "phi", "f"),
    ("χ", "chi", "c"),
    ("ψ", "psi", "y"),
    ("ω", "omega", "w"),
]


# Capitals become capital letters; the micro sign counts as mu, final sigma as sigma.
GREEK_SYMBOLS = "".join(symbol for symbol, _, _ in GREEK) + "".join(symbol.upper() for symbol, _, _ in GREEK) + "µς"
GREEK_LETTERS = "".join(letter for _, _, letter in GREEK) + "".join(letter.upper() for _, _, letter in GREEK) + "ms"


def greek_symbols_to_letters(col: Column) -> Column:
    """α → a, β → b …, Δ → D …; the micro sign counts as mu."""
    return F.translate(col, GREEK_SYMBOLS, GREEK_LETTERS)


def greek_words_to_letters(col: Column) -> Column:
    """alpha → a, beta → b …, longest words first.

    "mu", "eta" and "iota" occur inside ordinary words ("immune", "metal",
    "biota"), so these and words of up to three letters are only replaced where
    they stand alone.
    """
    out = col
    for _, word, letter in sorted(GREEK, key=lambda g: -len(g[1])):
        inside = len(word) > 3 and word != "iota"
        out = F.replace(out, F.lit(word), F.lit(letter)) if inside else F.regexp_replace(out, rf"\b{word}\b", letter)
    # Few texts hold such a word.
    return F.when(col.rlike("|".join(word for _, word, _ in GREEK)), out).otherwise(col)


def _folded_letters() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters with accents and ligatures, and their plain forms, from Unicode decomposition."""
    singles_from, singles_to, longer = [], [], []
    for code in [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07)]:
        char = chr(code)
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if plain.isascii() and plain != char and plain.strip():
            if len(plain) == 1:
                singles_from.append(char)
                singles_to.append(plain)
            elif char.isalpha():
                longer.append((char, plain))
    return "".join(singles_from), "".join(singles_to), longer


# Letters and marks Unicode does not decompose.
PLAIN_LETTERS = [
    ("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("Đ", "D"),
    ("“", '"'), ("”", '"'), ("„", '"'), ("‘", "'"), ("’", "'"), ("‚", "'"), ("–", "-"), ("—", "-"), ("−", "-"), ("…", "..."), ("\u00a0", " "),
]


def to_ascii(col: Column) -> Column:
    """Latin letters without accents, Greek symbols as Latin letters, plain quotes and dashes.

    Combining marks go. Other scripts stay as they are. Plain texts are returned
    as they are, and only texts with letters that become two go through the passes
    for those.
    """
    chars, plain, longer = _folded_letters()
    single = [(char, text) for char, text in PLAIN_LETTERS if len(text) == 1]

    def spelled_out(text: Column, letters: list[tuple[str, str]]) -> Column:
        out = text
        for char, plain_text in letters:
            out = F.replace(out, F.lit(char), F.lit(plain_text))
        return F.when(col.rlike(f"[{''.join(char for char, _ in letters)}]"), out).otherwise(text)

    # Letters of living spelling in one pass, ligatures and the like in another that few texts need.
    spelled = spelled_out(spelled_out(col, [(char, text) for char, text in PLAIN_LETTERS if len(text) > 1]), longer)
    bare = F.when(col.rlike(r"[\u0300-\u036F]"), F.regexp_replace(spelled, r"[\u0300-\u036F]", "")).otherwise(spelled)
    folded = F.translate(bare, GREEK_SYMBOLS + chars + "".join(c for c, _ in single), GREEK_LETTERS + plain + "".join(t for _, t in single))
    return F.when(col.rlike(r"[^\x00-\x7F]"), folded).otherwise(col)


def match_key(col: Column) -> Column:
    """Comparison key: Greek letters spelled in Latin, upper case, letters and digits only."""
    return F.upper(strip_non_alnum(greek_symbols_to_letters(col)))
