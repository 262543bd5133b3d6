"""Quality rules: a table of thresholds compiled into native column expressions, no user function.

``measured`` adds the measures, ``compiled`` turns the table into one boolean column. All of it
is a chain of projections over the scan: no shuffle, no Python.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null or empty text has no word, all its
measures are 0 and it is rejected; repeated rows are judged each for itself; an empty table gives
an empty table; columns of ``docs`` other than ``doc_id`` and ``text`` are not read by
``measures`` and are kept untouched by ``passing``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"

#: Frequent function words of the languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from had has have he her his i in is it not of on or she that the they this to was we were which "
    "will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur ne nous ou où par pas plus pour que qui sa se ses son "
    "sur un une vous "
    "al como con del el ella era es esta este la las le lo los más me mi no nos o para pero por que se si sin su sus un una uno y ya "
    "aber als am auf aus bei bin bis das dem den der die du ein eine einen er es für hat ich ihr im in ist mit nach nicht noch oder "
    "sich sie sind so über um und von war was wie wir zu zum zur"
).split()

#: (measure, least, most): a document stays if each measure lies within its bounds; None is no bound.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("repeat_word_ratio", None, 0.5),
    ("mean_word_chars", 2.0, 20.0),
    ("symbol_word_ratio", None, 0.3),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.7),
    ("ellipsis_line_ratio", None, 0.7),
    ("letter_word_ratio", 0.5, None),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _window_hashes(words: Column, n: Column) -> Column:
    """The hash of every three consecutive words, in order."""
    return F.when(
        n >= 3, F.transform(F.slice(words, F.lit(1), n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))


def _words_in_repeats(hashes: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more: sort with positions, keep equal neighbours, unite."""

    def covered(s: Column) -> Column:
        equal = F.filter(
            s, lambda p, k: F.coalesce((p["h"] == F.get(s, k - 1)["h"]) | (p["h"] == F.get(s, k + 1)["h"]), F.coalesce(p["h"] == F.get(s, k - 1)["h"], F.lit(False)), F.coalesce(p["h"] == F.get(s, k + 1)["h"], F.lit(False)))
        )
        return F.aggregate(
            F.sort_array(F.transform(equal, lambda p: p["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    heavy = F.get(F.transform(F.array(pairs), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), heavy).otherwise(F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``__q`` of all measures.

    The partition number in it keeps the optimizer from copying the measures' expressions into a
    filter on them, where a text would be split again for every one of its words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("__w", _words(whole)).withColumn(
        "__l", F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    step = step.withColumn("__h", _window_hashes(F.col("__w"), F.size("__w")))
    n, lines = F.size("__w").cast("long"), F.size("__l").cast("long")
    step = step.withColumn("__q", F.struct(
        n.alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (lines - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        _words_in_repeats(F.col("__h")).cast("long").alias("n_repeat_words"),
        lines.alias("n_lines"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
        F.size(F.filter("__l", lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("__w", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.spark_partition_id().alias("part"),
    ))
    return step.drop("__w", "__l", "__h")


def ratios(q: Column) -> dict[str, Column]:
    """Every name that a threshold may use."""
    n = q["n_words"]
    return {
        "n_words": n,
        "repeat_word_ratio": _ratio(q["n_repeat_words"], n),
        "mean_word_chars": _ratio(q["word_chars"], n),
        "symbol_word_ratio": _ratio(q["n_symbols"], n),
        "stop_word_ratio": _ratio(q["n_stop_words"], n),
        "dup_line_ratio": _ratio(q["n_dup_lines"], q["n_lines"]),
        "ellipsis_line_ratio": _ratio(q["n_ellipsis_lines"], q["n_lines"]),
        "letter_word_ratio": _ratio(q["n_letter_words"], n),
    }


def compiled(thresholds=THRESHOLDS, q: Column | None = None) -> Column:
    """The table as one boolean expression."""
    by_name = ratios(F.col("__q") if q is None else q)
    tests = [by_name[name] >= F.lit(low) for name, low, _ in thresholds if low is not None]
    tests += [by_name[name] <= F.lit(high) for name, _, high in thresholds if high is not None]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_ellipsis_lines", "n_letter_words",
)


def measures(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """doc_id, every measure, ``base_failed`` (too short or too repetitive) and ``kept``, a row for each document."""
    q = F.col("__q")
    return measured(docs.select("doc_id", "text")).select(
        "doc_id", *[q[name].alias(name) for name in MEASURES], _base_failed(q).alias("base_failed"),
        (~_base_failed(q) & compiled(thresholds)).alias("kept"),
    )


def _base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def passing(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that pass all rules, all their columns as they were."""
    return measured(docs).filter(~_base_failed(F.col("__q")) & compiled(thresholds)).select(*docs.columns)
