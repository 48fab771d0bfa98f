"""Quality rules, lines first, in DataFrame functions alone.

Each line with a word is held against three rules: punctuation (a line of four words or more has a sentence mark, and at
least half of its visible characters are letters or digits and a fifth at most symbols), navigation (it is not a row of separators or one of the usual
labels) and boilerplate (it has less than one of the usual phrases for each ``PHRASE_WORDS`` words). A missing mark counts only where marks are to be
expected: not in scripts that have none, and in a line no longer than a verse (``VERSE_WORDS``) only if the lines with words before and after it have
marks, so that verse, lists and other runs of unmarked lines stand. Lines that fail are removed. A document is rejected when it
fails the base rules, or when the lines removed hold over half of the characters of its words.

Words are ``[^\\x20\\x09-\\x0D]+``. Null text has none; it fails the base. Lines end at ``\\n``. Repeated rows are judged each
on its own; ids pass through; an empty table gives an empty result. Columns added are those of ``FIGURES``, ``kept`` and
``clean_text``; a column of such a name in the input is replaced by ``judge``, while ``clean`` returns the input's own. Very long
texts are judged whole; ties do not arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 20
WINDOW_WORDS = 8
MOST_REPEATED_PERCENT = 30
MOST_LOST_PERCENT = 50
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars")

PHRASE_WORDS = 25
"""A phrase of boilerplate counts for so many words of its line."""
VERSE_WORDS = 15
"""A line of more words needs a sentence mark of its own."""

#: Lower-case phrases of boilerplate, and labels of navigation.
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "javascript is disabled", "javascript enabled", "use a cookie", "use cookies", "uses cookies", "accept cookies", "cookie policy", "cookie settings",
    "privacy policy", "terms of use", "terms of service", "all rights reserved", "subscribe to our", "sign up for our newsletter", "click here to",
    "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados", "tutti i diritti riservati",
)
LABELS = ("home", "menu", "login", "log in", "sign in", "sign up", "search", "next", "previous", "back to top", "share", "contact us", "about us", "sitemap", "skip to content", "read more")

SPACE = r"[\x20\x09-\x0D]"
VISIBLE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Sentence marks of scripts in wide use: Latin, Arabic, Urdu, Devanagari, Armenian, Ethiopic, Khmer, Burmese, Tibetan, Chinese, Japanese.
MARKS = r"[.!?…:;؟؛۔।॥։՜՞።፧፨។៕၊။།༎。！？｡．：；]"
SEPARATORS = r"[|»›•]"
#: Letters of scripts that mark no sentences: Thai and Lao.
UNMARKED = "[\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ebd\u0ec0-\u0ece]"


def _counts(line: Column) -> dict[str, Column]:
    """Of a line what several rules ask: its words, its visible characters, and whether it has a mark."""
    return {"words": F.regexp_count(line, F.lit(f"{VISIBLE}+")), "visible": F.length(line) - F.regexp_count(line, F.lit(SPACE)), "marked": line.rlike(MARKS)}


def _rules(line: Column, counts: dict[str, Column]) -> dict[str, Column]:
    """Of a line that has a word: whether it fails by itself, lacks a mark, is longer than a verse, and has a mark."""
    low, words, visible, marked = F.lower(line), counts["words"], counts["visible"], counts["marked"]
    plain = F.length(line) - F.regexp_count(line, F.lit(r"[^\p{L}\p{M}\p{N}]"))
    shape = (plain * 2 < visible) | (F.regexp_count(line, F.lit(SYMBOLS)) * 5 > visible)
    navigation = (F.regexp_count(line, F.lit(SEPARATORS)) >= 3) | low.rlike(rf"^\W*(?:{'|'.join(LABELS)})\W*$")
    # Most characters begin no phrase, which one look tells.
    phrases = F.regexp_count(low, F.lit(f"(?=[{''.join(sorted({p[0] for p in BOILERPLATE}))}])(?:{'|'.join(BOILERPLATE)})"))
    boilerplate = (phrases > 0) & (phrases * PHRASE_WORDS >= words)
    return {"fails": shape | navigation | boilerplate, "lacks": (words >= 4) & ~marked & ~line.rlike(UNMARKED), "long": words > VERSE_WORDS, "marked": marked}


def line_fails(line: Column) -> Column:
    """For a line that has a word and stands between lines with marks."""
    told = _rules(line, _counts(line))
    return told["fails"] | told["lacks"]


def _bad_lines(told: Column) -> Column:
    """Of lines with their rules those that fail."""

    def fails(t: Column, k: Column) -> Column:
        before, after = F.get(told, k - 1), F.get(told, k + 1)
        expected = F.coalesce(before["marked"], F.lit(True)) & F.coalesce(after["marked"], F.lit(True)) & (before.isNotNull() | after.isNotNull())
        return t["fails"] | (t["lacks"] & (t["long"] | expected))

    return F.filter(told, fails)


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"{SPACE}+", "")).cast("long")


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the figures, ``kept``, and ``clean_text`` without the lines that fail. To filter by ``kept``, use ``clean``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    read = docs.withColumns({"__words": F.array_remove(F.split(whole, f"{SPACE}+"), ""), "__lines": F.split(whole, "\n")})
    filled = F.filter(F.transform("__lines", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda t: t["x"].rlike(VISIBLE))
    read = read.withColumns({"n_words": F.size("__words").cast("long"), "__filled": filled})
    # Each line is counted once and meets the rules once.
    counted = F.transform("__filled", lambda t: F.struct(t["i"].alias("i"), t["x"].alias("x"), *[c.alias(n) for n, c in _counts(t["x"]).items()]))
    told = F.transform(counted, lambda t: F.struct(t["i"].alias("i"), t["x"].alias("x"), *[c.alias(n) for n, c in _rules(t["x"], {n: t[n] for n in ("words", "visible", "marked")}).items()]))
    read = read.withColumn("__told", told)
    starts = F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW_WORDS - 1))
    hashes = F.when(F.col("n_words") >= WINDOW_WORDS, F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, WINDOW_WORDS)))).otherwise(F.array().cast("array<long>"))
    hashed = read.withColumns({"__hashes": hashes, "__bad": _bad_lines(F.col("__told")), "n_dup_lines": (F.size("__filled") - F.size(F.array_distinct(F.transform("__filled", lambda t: t["x"])))).cast("long")})
    # Windows in the order of their hashes: those found twice or more are equal to a neighbour.
    sorted_windows = F.array_sort(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = hashed.withColumn("__windows", F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), sorted_windows))
    twice = F.filter("__windows", lambda w, k: F.coalesce(w["h"] == F.get("__windows", k - 1)["h"], F.lit(False)) | F.coalesce(w["h"] == F.get("__windows", k + 1)["h"], F.lit(False)))
    found = ordered.withColumn("__starts", F.array_sort(F.transform(twice, lambda w: w["i"])))
    start = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("__starts", start, lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW_WORDS), i - s["last"])).alias("n")), lambda s: s["n"])
    lost = F.aggregate("__bad", F.lit(0).cast("long"), lambda n, t: n + word_chars(t["x"]))
    counted = found.withColumns({"word_chars": F.length(F.array_join("__words", "")).cast("long"), "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"), "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")), "lost_chars": lost})
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.transform("__bad", lambda t: t["i"]))
    clean = F.when(F.size("__bad") > 0, F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")).otherwise(F.col(text))
    judged = counted.withColumns({"base_failed": base, "clean_text": clean})
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MOST_LOST_PERCENT * F.col("word_chars"))
    return judged.withColumn("kept", kept).drop("__words", "__lines", "__filled", "__told", "__hashes", "__bad", "__windows", "__starts")


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents, with the lines that fail removed from their text."""
    own = {c: f"__own_{c}" for c in docs.columns if c in {*FIGURES, "kept", "clean_text"} - {text}}
    docs, names = docs.withColumnsRenamed(own), docs.columns
    judged = judge(docs, text).select(*[c for c in docs.columns if c != text], "kept", F.col("clean_text").alias(text), F.monotonically_increasing_id().alias("__row"))
    # A filter above a row number stays there; below, the optimizer would write out all figures in its condition.
    return judged.where(F.col("kept") & (F.col("__row") >= 0)).select(*[F.col(own.get(c, c)).alias(c) for c in names])
