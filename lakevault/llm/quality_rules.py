"""Quality rules: a threshold table compiled into one projection of built-in functions.

No shuffle, no user function: every measure is computed from a row's own text, so a hot source
or a group of copies costs what its rows cost.

Defined results: a null text has no words and fails; an empty text likewise; repeated rows are
measured each for itself; an empty table gives an empty result; ``keep`` carries every column
whatever its name, ``measure`` replaces a column named ``quality``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII blanks, as trimmed characters and as a class: a word is a run of anything else.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Frequent function words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in is that it for was on are as with they be at "
    "le la les de du des et un une en que qui dans pour "
    "der die das und den von zu mit sich ist nicht ein eine "
    "el los las y se del con por su para al lo").split()


class Rule(NamedTuple):
    """A text of at least ``from_words`` words fails unless low <= measure / per <= high."""

    name: str
    measure: str
    per: str | None
    low: float | None
    high: float | None
    from_words: int = 1


#: The rules every text must pass whatever the table says.
BASE = (
    Rule("few_words", "n_words", None, 10, None, 0),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.2),
)

TABLE = (
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations", "n_exclamations", "n_words", None, 0.5),
    Rule("word_length", "word_chars", "n_words", 2, 14),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, 50),
    Rule("upper_case", "n_upper", "word_chars", None, 0.6),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_exclamations", "n_stop_words", "n_upper", "n_lines")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; none for a null, empty or blank one."""
    body = F.btrim(text, F.lit(BLANKS))
    return F.when(F.char_length(body) > 0, F.split(body, BLANK_RUN)).otherwise(
        F.array().cast("array<string>"))


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the given ascending positions."""
    return F.aggregate(
        positions, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["n"] + p + WINDOW - F.greatest(a["end"], p)).cast("int").alias("n"),
            (p + WINDOW).cast("int").alias("end")),
        lambda a: a["n"])


def _repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more in the text, the first occurrence included.

    Windows are compared by a 64-bit hash of their words. Only texts that have a repeated window
    at all sort theirs: equal windows then are neighbours, whatever their number.
    """
    def of(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(
            h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            marked = F.transform(s, lambda x, k: F.when(
                (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
            return _covered(F.array_sort(F.array_compact(marked)))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            _let(ordered, repeated))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(
        _let(_let(hashes, windows), of))


def _measures(text: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda s: F.char_length(F.btrim(s, F.lit(BLANKS))) > 0)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": _let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))),
        "n_lines": F.size(lines),
        "n_repeat_words": _repeated_words(words),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
    }
    return {k: counts[k].cast("long") for k in COUNTS}


def fails(rule: Rule, m: Column) -> Column:
    """Whether a text with these measures breaks the rule. Multiplied out: no division."""
    value, per = m[rule.measure], m[rule.per] if rule.per else F.lit(1)
    out = F.lit(False)
    if rule.low is not None:
        out = out | (value < F.lit(rule.low) * per)
    if rule.high is not None:
        out = out | (value > F.lit(rule.high) * per)
    return out & (m["n_words"] >= rule.from_words)


def measure(docs: DataFrame, text: str = "text", table=TABLE, base=BASE) -> DataFrame:
    """The input with one more column ``quality``: a struct of all counts, ``base_failed``,
    ``failed`` (names of broken rules of the table) and ``kept``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    taken = {c.lower() for c in docs.columns}
    tmp = next(n for n in ("_w", "_w_", "_w__", "_words_of_text_") if n not in taken)
    listed = docs.withColumn(tmp, words_of(body))
    counted = listed.withColumn(tmp, F.struct(*(
        c.alias(k) for k, c in _measures(body, F.col(tmp)).items())))
    m = F.col(tmp)
    names = F.array_compact(F.array(*(
        F.when(fails(r, m), F.lit(r.name)) for r in table))) if table else F.array().cast(
        "array<string>")
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | fails(rule, m)
    out = counted.withColumn("quality", F.struct(
        *(m[k].alias(k) for k in COUNTS), base_failed.alias("base_failed"),
        names.alias("failed")))
    q = F.col("quality")
    return out.drop(tmp).withColumn("quality", q.withField(
        "kept", ~q["base_failed"] & (F.size(q["failed"]) == 0)))


def keep(docs: DataFrame, text: str = "text", table=TABLE, base=BASE) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.col(f"`{text}`").alias("text"))
    judged = measure(inner, "text", table, base)
    # a filter would be pushed below the projections, and the measures computed once more in it
    return judged.select(F.inline(F.when(F.col("quality.kept"), F.array("row"))))
