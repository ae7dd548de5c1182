"""Line-first cleaning: failing lines go, then documents that lost too much text go.

Everything is a DataFrame expression within the row of a document: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower, words

#: Characters that running text has few of.
SYMBOLS = "#*$%&|<>"
#: Ends of a sentence, closing quotes and brackets allowed after them.
SENTENCE_END = r"[.!?;:…][\"'”’»)\]]*[ \t\r]*$"
#: Doubled marks as in "now!!", which prose has rarely.
LOUD = ("!!", "??")
SEPARATORS = "|»›•·"
NAVIGATION = (
    r"(?i)^[ \t]*(home|menu|log ?in|log ?out|sign (in|up)|next|previous|back( to top)?|read more|share|search"
    r"|subscribe|contact( us)?|about( us)?|sitemap|skip to (main )?content)[ \t\r.:>]*$"
)
BOILERPLATE = (
    "all rights reserved", "use cookies", "uses cookies", "accept cookies", "accept all cookies", "enable cookies",
    "enable javascript", "terms of use", "terms of service", "privacy policy", "licensed under", "released under",
    "copyright ©", "copyright (c)", "lorem ipsum",
)
#: A text without any of these has no line that fails for its marks.
MARKS = r"[#*$%&|<>»›•·]|!!|\?\?"

#: Most share of symbols among a line's characters, of doubled marks by its words, and of a document's word characters that may go.
MAX_SYMBOLS, MAX_LOUD, MAX_LOST = 0.08, 0.3, 0.3
#: Most words of a line that a boilerplate phrase takes out, and least separators a word of a list: running text that mentions a
#: phrase or holds some separators stays.
MAX_BOILERPLATE_WORDS, MIN_SEPARATORS, LIST_SHARE = 30, 3, 0.1
RULES = ("boilerplate", "navigation", "punctuation")
MIN_WORDS, MAX_REPEATED = 50, 50
#: Low bits of a window's key that hold its position: texts of up to 268 million words.
_POSITION = (1 << 28) - 1


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _joined(w: Column) -> Column:
    return F.char_length(F.array_join(w, "")).cast("long")


def _held(text: Column, part: str) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def _separators(line: Column, low: Column) -> Column:
    """Separators of a list: neither a » that closes a « (or, in »so«, opens one) nor the dot of l·l."""
    quoted = F.least(_count(line, "«"), _count(line, "»"))
    return _count(line, SEPARATORS) - quoted - _held(low, "l·l")


def line_fault(line: Column, low: Column, n: Column, marked: Column) -> Column:
    """The rule a line of ``n`` words fails, else null: ``boilerplate`` phrases in lines of up to 30 words; ``navigation`` labels,
    lists cut by three separators and one for ten words, or one to three words without a sentence end; ``punctuation`` where symbols or
    doubled marks prevail. Lines without a word pass. ``low``: the line lowered; ``marked``: whether the text
    holds any of MARKS at all."""
    said = F.contains(low, F.lit(BOILERPLATE[0]))
    for phrase in BOILERPLATE[1:]:
        said = said | F.contains(low, F.lit(phrase))
    cuts = _separators(line, low)
    loud = sum((_held(line, m) for m in LOUD[1:]), _held(line, LOUD[0]))
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when((n <= MAX_BOILERPLATE_WORDS) & said, "boilerplate")
        .when(((n <= 3) & ~line.rlike(SENTENCE_END)) | line.rlike(NAVIGATION) | (marked & (cuts >= MIN_SEPARATORS) & (cuts >= LIST_SHARE * n)), "navigation")
        .when(marked & ((_count(line, SYMBOLS) > MAX_SYMBOLS * F.char_length(line)) | (loud > MAX_LOUD * n)), "punctuation")
    )


def window_keys(w: Column) -> Column:
    """A sorted (hash, position) number for each three-word window; null for a text of under three words."""
    at = lambda i: F.get(w, i)
    key = lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)).bitwiseAND(F.lit(~_POSITION)).bitwiseOR(i.cast("long"))
    return F.when(F.size(w) >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), key)))


def beside_equal(a: Column, same) -> Column:
    """Positions in a sorted array whose neighbour before or after is the same."""
    no = F.lit(False)
    return F.filter(
        F.sequence(F.lit(0), F.size(a) - 1),
        lambda i: F.coalesce(same(F.get(a, i), F.get(a, i + 1)), no) | F.coalesce(same(F.get(a, i), F.get(a, i - 1)), no),
    )


def alike(keys: Column) -> Column:
    """Positions of windows whose hash another window of the text has."""
    high = lambda k: k.bitwiseAND(F.lit(~_POSITION))
    found = beside_equal(keys, lambda x, y: high(x) == high(y))
    return F.transform(found, lambda i: F.get(keys, i).bitwiseAND(F.lit(_POSITION)).cast("int"))


def _is(rule: str):
    return lambda fault: F.coalesce(fault == rule, F.lit(False))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of its whole texts, its cleaned text and the verdict.

    Added (a column of the same name is replaced): n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines, line_faults (rule -> lines), lost_share, clean_text, kept.
    A null or empty text has no words and fails; repeated rows each get the same result.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.withColumns({
        "__w": words(t), "__marked": t.rlike(MARKS), "__lines": F.split(t, "\n", -1), "__low": F.split(ascii_lower(t), "\n", -1),
    })
    out = out.withColumn("__lines", F.zip_with("__lines", "__low", lambda x, low: F.struct(x.alias("x"), low.alias("low"), F.size(words(x)).alias("n"))))
    out = out.withColumn("__keys", window_keys(F.col("__w")))
    out = out.withColumns({
        "__near": F.when(F.size("__keys") > 1, alike(F.col("__keys"))),
        "__faults": F.transform("__lines", lambda e: line_fault(e["x"], e["low"], e["n"], F.col("__marked"))),
        "__real": F.transform(F.filter("__lines", lambda e: e["n"] > 0), lambda e: e["x"]),
    })
    # the same hash is not yet the same window: those few are sorted again by their words
    gram = lambda p: F.concat_ws(" ", F.get("__w", p), F.get("__w", p + 1), F.get("__w", p + 2))
    out = out.withColumn("__exact", F.sort_array(F.transform("__near", lambda p: F.struct(gram(p).alias("g"), p.alias("p")))))
    twice = beside_equal(F.col("__exact"), lambda x, y: x["g"] == y["g"])
    start = lambda i: F.get("__exact", i)["p"]
    covered = F.flatten(F.transform(twice, lambda i: F.array(start(i), start(i) + 1, start(i) + 2)))
    out = out.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": _joined(F.col("__w")),
        "n_symbols": _count(t, SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("__real") - F.size(F.array_distinct("__real"))).cast("long"),
        "n_repeat_words": F.when(F.size("__exact") > 1, F.size(F.array_distinct(covered))).otherwise(0).cast("long"),
        "n_lines": F.size("__real").cast("long"),
        "line_faults": F.map_from_arrays(
            F.array(*map(F.lit, RULES)), F.array(*[F.size(F.filter("__faults", _is(r))) for r in RULES])
        ),
        "clean_text": F.array_join(F.transform(F.filter("__lines", lambda e, i: F.get("__faults", i).isNull()), lambda e: e["x"]), "\n"),
    })
    lost = F.when(F.col("word_chars") > 0, 1 - _joined(words(F.col("clean_text"))) / F.col("word_chars")).otherwise(0.0)
    out = out.withColumns({
        "lost_share": lost,
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    })
    # a row number keeps filters on the verdict above the measures: pushed below, they would be computed all once more
    here = F.monotonically_increasing_id() >= 0
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= MAX_LOST) & here)
    return out.drop("__w", "__lines", "__keys", "__near", "__faults", "__real", "__marked", "__exact", "__low")


def cleaned(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that are kept, without their failing lines, in the columns of ``docs``. Where there
    is a column ``n_chars`` it holds the code points of the cleaned text."""
    bare = measured(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{text}`").alias("text")))
    row = lambda c: F.col("clean_text") if c == text else F.char_length("clean_text").cast("long") if c == n_chars else F.col("__row")[c]
    return bare.filter("kept").select(*[row(c).alias(c) for c in docs.columns])
