"""Text features as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import fixed_values as V

# word and blank classes of the detectors, spelled out because engines differ on \\w and \\s
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
# the same blanks as characters
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BASE64_RUN = r"[A-Za-z0-9+/]{30,}={0,2}"
DIGIT_LETTER_DIGIT = r"[0-9][a-zA-Z][0-9]"
SPACED_LETTERS = f"({WORD}{BLANK}){{10,}}"
NON_ASCII_SHARE = 0.15


def strip(text: Column) -> Column:
    """Leading and trailing blanks of any kind removed (``trim`` only removes spaces)."""
    return F.btrim(text, F.lit(BLANKS))


def occurrences(text: Column, token: str) -> Column:
    """Non-overlapping hits of ``token``."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))
    return (removed / len(token)).cast("int")


def token_hits(text: Column, tokens: Sequence[str]) -> Column:
    """Hits of all tokens, ignoring case."""
    lowered = F.lower(text)
    total = F.lit(0)
    for token in tokens:
        total = total + occurrences(lowered, token.lower())
    return total


def special_token_count(text: Column, tokens: Sequence[str] = V.SPECIAL_TOKENS) -> Column:
    return token_hits(text, tokens)


def imperative_density(text: Column, verbs: Sequence[str] = V.IMPERATIVE_VERBS) -> Column:
    """Share of the words that are command verbs, 0 for a text without words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-zA-Z']+"), F.lit(0))
    commands = F.filter(words, lambda w: w.isin(list(verbs)))
    return F.coalesce(F.try_divide(F.size(commands), F.size(words)), F.lit(0.0))


def lexicon_score(text: Column, phrases: Sequence[str] = V.ROLEPLAY_LEXICON) -> Column:
    """Phrase hits per hundred characters; texts under a hundred count as a hundred."""
    return token_hits(text, phrases) / F.greatest(F.length(text) / 100, F.lit(1.0))


def text_length(text: Column) -> Column:
    return F.length(text)


def char_entropy(text: Column) -> Column:
    """Shannon entropy in bits of the characters of a text, 0 for an empty or absent one.

    Characters are sorted within the row and counted as runs, so nothing is shuffled and the alphabet's size costs nothing."""
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.transform(F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*+"), F.lit(0)), lambda run: F.length(run).cast("double"))
    weighted = F.aggregate(runs, F.lit(0.0), lambda total, c: total + c * F.log2(c))
    n = F.length(text).cast("double")
    # one repeated character gives a rounding error around zero
    bits = F.greatest(F.log2(n) - F.try_divide(weighted, n), F.lit(0.0))
    return F.coalesce(bits, F.lit(0.0))


@F.pandas_udf(T.StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    """Unicode NFKD form; Spark has no built-in for it."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


def normalized(text: Column) -> Column:
    """NFKD form."""
    return nfkd(text)


def is_ascii(text: Column) -> Column:
    return ~F.regexp_like(text, F.lit(r"[^\x00-\x7F]"))


def non_ascii_share(text: Column) -> Column:
    kept = F.length(F.regexp_replace(text, r"[\x00-\x7F]", ""))
    return kept / F.greatest(F.length(text), F.lit(1))


def obfuscation_signals(text: Column) -> dict[str, Column]:
    """The four detectors on a text that is already normalised."""
    return {
        "non_ascii": non_ascii_share(text) > NON_ASCII_SHARE,
        "base64_run": F.regexp_like(text, F.lit(BASE64_RUN)),
        "digit_letter_digit": F.regexp_like(text, F.lit(DIGIT_LETTER_DIGIT)),
        "spaced_letters": F.regexp_like(text, F.lit(SPACED_LETTERS)),
    }


def is_obfuscated(text: Column) -> Column:
    signals = obfuscation_signals(text)
    return (
        signals["non_ascii"]
        | signals["base64_run"]
        | signals["digit_letter_digit"]
        | signals["spaced_letters"]
    )


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | text.contains(phrase)
    return hit


def rule_category(
    text: Column,
    is_attack: Column,
    obfuscated: Column,
    roleplay: Sequence[str] = V.ROLEPLAY_KEYWORDS,
    override: Sequence[str] = V.OVERRIDE_KEYWORDS,
    direct: Sequence[str] = V.DIRECT_KEYWORDS,
) -> Column:
    """First matching rule wins; an attack that matches nothing is a direct injection, so the
    ``direct`` list changes no result and is kept for reporting."""
    lowered = F.lower(text)
    return (
        F.when(~is_attack, "benign")
        .when(obfuscated, "obfuscation")
        .when(contains_any(lowered, roleplay), "roleplay")
        .when(contains_any(lowered, override), "instruction_override")
        .when(contains_any(lowered, direct), "direct_injection")
        .otherwise("direct_injection")
    )


def admitted(text: Column, longer_than: int = 3) -> Column:
    return F.length(strip(text)) > longer_than


# --- obfuscated variants -------------------------------------------------------------------------


def leetspeak(text: Column) -> Column:
    return F.translate(text, V.LEET_FROM, V.LEET_TO)


def lookalikes(text: Column) -> Column:
    return F.translate(text, V.LATIN, V.LOOKALIKE)


def base64_wrap(text: Column) -> Column:
    encoded = F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")
    return F.concat(F.lit(V.BASE64_PREFIX), encoded)


def _chance(seed: int, *parts: Column) -> Column:
    """A repeatable number in [0, 1) drawn from a hash of the parts."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1_000_000)) / 1_000_000


def zero_width(text: Column, key: Column, seed: int = 42, share: float = 0.3) -> Column:
    """A zero-width character after a ``share`` of the characters."""
    marks = F.array(*[F.lit(c) for c in V.ZERO_WIDTH])
    pick = lambda i: F.element_at(marks, (F.pmod(F.xxhash64(F.lit(seed + 1), key, i), F.lit(3)) + 1).cast("int"))
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(_chance(seed, key, i) < share, F.concat(c, pick(i))).otherwise(c),
        ),
        "",
    )


def spaced_out(text: Column, key: Column, seed: int = 42, share: float = 0.5) -> Column:
    """Spaces between the letters of a ``share`` of the words longer than three letters."""
    letters = lambda w: F.array_join(F.filter(F.split(w, ""), lambda c: c != ""), " ")
    return F.array_join(
        F.transform(
            F.split(text, " "),
            lambda w, i: F.when((_chance(seed, key, i) < share) & (F.length(w) > 3), letters(w)).otherwise(w),
        ),
        " ",
    )


def fill_template(template: Column, **values: Column) -> Column:
    """``{name}`` slots of the template replaced by the named columns."""
    filled = template
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value)
    return filled
