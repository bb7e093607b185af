"""Quality rules as one native expression: a cascade that stops at the first rule a text breaks.

Rules are ordered by what a sample says about them: texts rejected per second of work. The order
changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.session import staged

BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_words(of: Column) -> Column:
    """How many of the words lie in a five-word window that occurs twice or more."""

    def windows(hashes: Column) -> Column:
        starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
        return F.transform(starts, lambda h, i: F.xxhash64(h, *(hashes[i + k] for k in range(1, WINDOW))))

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda p, k: F.when(k < F.size(places) - 1, F.least(F.lit(WINDOW), places[k + 1] - p)).otherwise(WINDOW)
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def twice(ranked: Column) -> Column:
        last = F.size(ranked) - 1
        same = F.filter(
            ranked,
            lambda x, k: ((k > 0) & (ranked[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
            | ((k < last) & (ranked[F.least(k + 1, last)]["h"] == x["h"])),
        )
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def found(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(ranked, twice)).otherwise(F.lit(0))

    return let(F.transform(of, lambda w: F.xxhash64(w)), lambda h: let(windows(h), found)).cast("long")


def _kept_chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


#: What rules look at, each a function of the text alone.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda t: F.size(words(t)).cast("long"),
    "word_chars": lambda t: _kept_chars(t, BLANK),
    "n_symbols": lambda t: _kept_chars(t, "[^#*$%&|<>]+"),
    "n_capitals": lambda t: _kept_chars(t, "[^A-Z]+"),
    "n_lines": lambda t: F.size(_lines(t)).cast("long"),
    "n_dup_lines": lambda t: let(_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda t: let(words(t), repeated_words),
}


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


@dataclass(frozen=True)
class Rule:
    """A text breaks the rule where ``broken``, given the measures it ``needs``, is true."""

    name: str
    needs: tuple[str, ...]
    broken: Callable[..., Column]


BASE = [
    Rule("too_short", ("n_words",), lambda n: n < 10),
    Rule("repetition", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 20 * n),
]
RULES = [
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("capitals", ("word_chars", "n_capitals"), lambda c, u: 2 * u > c),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 15 * n)),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda n, d: 2 * d > n),
]


def _broken(rule: Rule, text: Column, known: dict[str, Column]) -> Column:
    return rule.broken(*(known.get(m, MEASURES[m](text)) for m in rule.needs))


def cascade_order(documents: DataFrame, text_col: str, rules: list[Rule], sample_rows: int = 300) -> list[Rule]:
    """The rules by texts rejected per second on a sample of at most ``sample_rows`` texts, given the rules before.

    The sample comes from the first partitions that hold it, so the corpus is not read for it, and stays in the shared
    folder: the driver gets each rule's verdicts and the time it takes. Without texts the order stays as it is.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sample = staged(documents.select(text.alias("t")).sample(0.1, seed=7).limit(sample_rows), "sample")
    verdicts = sample.select(*(F.coalesce(_broken(r, F.col("t"), {}), F.lit(False)) for r in rules)).collect()
    if not verdicts:
        return list(rules)
    seconds = []
    for rule in rules:
        query = sample.agg(F.count_if(_broken(rule, F.col("t"), {})))
        query.first()  # the plan is compiled
        taken = []
        for _ in range(3):
            begin = time.perf_counter()
            query.first()
            taken.append(time.perf_counter() - begin)
        seconds.append(min(taken))
    return [rules[k] for k in greedy_order([tuple(v) for v in verdicts], seconds)]


def greedy_order(verdicts: list[tuple[bool, ...]], seconds: list[float]) -> list[int]:
    """Rules by rejections per second among the texts that the rules before let through; cheaper ones first on a tie."""
    left, order, open_rules = verdicts, [], set(range(len(seconds)))
    while open_rules:
        best = max(open_rules, key=lambda k: (sum(v[k] for v in left) / seconds[k], -seconds[k], -k))
        order.append(best)
        open_rules.remove(best)
        left = [v for v in left if not v[best]]
    return order


def passes(text: Column, rules: list[Rule], known: dict[str, Column] | None = None) -> Column:
    """Whether a text breaks none of the rules; a rule is evaluated only where the ones before it hold.

    ``known`` gives measures that exist as columns. A null text is an empty one.
    """
    verdict = None
    for rule in rules:
        broken = _broken(rule, F.coalesce(text.cast("string"), F.lit("")), known or {})
        verdict = F.when(broken, False) if verdict is None else verdict.when(broken, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def assess(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` (named as in the input), all measures, ``base_failed`` and ``kept``, one row per input row.

    A null text counts as an empty one: it has no words and fails. Repeated rows and null ids
    are rows like others; columns other than the two are not read.
    """
    order = cascade_order(documents, text_col, RULES)
    rows = documents.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    both = let(words(F.col("_t")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    plain = [m for m in MEASURES if m not in ("n_words", "n_repeat_words")]
    measured = rows.select(F.col(id_col), both.alias("_w"), *(MEASURES[m](F.col("_t")).alias(m) for m in plain))
    measured = measured.select(
        id_col, F.col("_w.n").alias("n_words"), F.col("_w.r").alias("n_repeat_words"), *plain
    )
    known = {m: F.col(m) for m in MEASURES}
    base = _broken(BASE[0], F.lit(""), known) | _broken(BASE[1], F.lit(""), known)
    judged = measured.withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & passes(F.lit(""), order, known))


def keep_good(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns as they are, that break no rule."""
    return documents.where(passes(F.col(text_col), cascade_order(documents, text_col, BASE + RULES)))
