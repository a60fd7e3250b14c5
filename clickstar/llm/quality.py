"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule says of a document whether it passes. On a sample, each rule's cost is timed and the rows
that it rejects noted; then rules are put in order, always the one next that rejects most of what
the others let through per second. The verdict is one conditional expression in that order, so a
document is looked at up to the first rule that rejects it. The order changes the cost and never
the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 8
#: Rows of the sample that rules are timed on.
SAMPLE_ROWS = 2_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows that are found twice or more, the first time included.

    Windows are compared by a 64-bit hash. Their hashes are sorted with their places, so equal ones
    are neighbours; the places of those, in order, give the words they cover.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(pairs: Column) -> Column:
            def twice(pair: Column, k: Column) -> Column:
                around = [F.get(pairs, k + step).getField("h") for step in (-1, 1)]
                return F.coalesce(around[0] == pair["h"], F.lit(False)) | F.coalesce(
                    around[1] == pair["h"], F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(pairs, twice), lambda pair: pair["i"]))

        def add(state: Column, start: Column) -> Column:
            end = start + window
            return F.struct(
                (state["n"] + end - F.greatest(start, state["end"])).alias("n"), end.alias("end")
            )

        nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(_let(placed, starts), nothing, add, lambda state: state["n"])

    def hashed(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - (window - 1))
        return F.transform(places, lambda i: F.xxhash64(F.slice(w, i, window)))

    def counted(hashes: Column) -> Column:
        unlike = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unlike, F.lit(0)).otherwise(covered(hashes))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(
        _let(words, lambda w: _let(hashed(w), counted))
    )


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    return _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def with_measures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text, words`` and the base measures; a null text has none of anything."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    base = base.withColumn("words", words_of(F.col("text")))
    spaces = F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))
    measures = {
        "n_words": F.size("words"),
        "word_chars": F.char_length("text") - spaces,
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": repeated_lines(F.col("text")),
        "n_repeat_words": repeated_words(F.col("words")),
    }
    return base.withColumns({name: m.cast("long") for name, m in measures.items()})


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """``passes`` over ``text``, ``words`` and the base measures."""

    name: str
    passes: Column


def standard_rules() -> list[Rule]:
    """What a page of prose passes. Made when a session is there."""
    n = F.col("n_words")
    words, text = F.col("words"), F.col("text")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    stutter = F.size(
        F.filter(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: F.get(words, i) == F.get(words, i - 1),
        )
    )
    lettered = F.size(F.filter(words, lambda word: F.regexp_like(word, F.lit(r"\p{L}"))))
    return [
        Rule("few_symbols", 10 * F.col("n_symbols") <= n),
        Rule("word_length", (F.col("word_chars") >= 2 * n) & (F.col("word_chars") <= 12 * n)),
        Rule("few_repeated_lines", 10 * F.col("n_dup_lines") <= 4 * (count("\n") + 1)),
        Rule("few_exclamations", 10 * count("!") <= n),
        Rule("few_capitals", 10 * count(r"\p{Lu}") <= 4 * F.col("word_chars")),
        Rule("no_stutter", F.when(n < 2, True).otherwise(10 * stutter <= 3 * n)),
        Rule("lettered_words", 10 * lettered >= 5 * n),
    ]


def cascade(rules: list[Rule]) -> Column:
    """Whether a row passes all rules, looked at in order and no further than needed."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.passes, F.lit(False)), verdict).otherwise(F.lit(False))
    return verdict


def ordered_rules(rows: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost on a sample of about ``sample_rows``, which bounds what is
    timed and brought to the driver: a few booleans a row. The order has no say in any verdict."""
    total = rows.count()
    sample = rows.sample(min(1.0, sample_rows / max(1, total)), seed=11)
    sample = sample.persist(StorageLevel.MEMORY_AND_DISK)
    rejects = [~F.coalesce(rule.passes, F.lit(False)) for rule in rules]
    named = [c.alias(rule.name) for c, rule in zip(rejects, rules, strict=True)]
    left = [set(r.name for r in rules if row[r.name]) for row in sample.select(named).collect()]

    def seconds(condition: Column) -> float:
        began = time.monotonic()
        sample.agg(F.count(F.when(condition, 1))).collect()
        return time.monotonic() - began

    seconds(F.lit(True))  # the first run compiles and fills the cache
    idle = seconds(F.lit(True))
    cost = {
        rule.name: max(1e-3, seconds(condition) - idle)
        for rule, condition in zip(rules, rejects, strict=True)
    }
    sample.unpersist()
    order: list[Rule] = []
    waiting = list(rules)
    while waiting:
        best = max(waiting, key=lambda r: (sum(r.name in row for row in left) / cost[r.name], r.name))
        order.append(best)
        waiting.remove(best)
        left = [row for row in left if best.name not in row]
    return order


def quality_verdicts(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``
    for each row: ``kept`` if the base does not fail and all rules pass.

    A null or empty text has no words, so its base fails. Repeated rows stay repeated, a null id
    stays null, further columns are not read; an empty table gives an empty one. There is no
    shuffle and no Python on the rows; a row's words and windows are all that is held.
    """
    rules = standard_rules() if rules is None else rules
    rows = with_measures(docs, id_column, text_column)
    # Drawn before they are measured, so that only the sample's texts are measured twice.
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    order = ordered_rules(with_measures(docs.sample(share, seed=11), id_column, text_column), rules)
    failed = base_failed()
    verdict = F.when(failed, F.lit(False)).otherwise(cascade(order))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        F.col("doc_id").alias(id_column),
        *measures,
        failed.alias("base_failed"),
        verdict.alias("kept"),
    )
