"""Quality rules that vote, instead of rules that must all pass.

Every rule approves (1), objects (-1) or abstains (0). Expectation-maximisation over the counted vote patterns estimates how often
each rule approves or objects among good and among bad texts; a text is kept when its posterior probability of being good reaches
``KEEP``. Everything is DataFrame expressions; the fit sees one row per vote pattern, at most 3 ** len(RULES).
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.once import with_columns_once
from quipu.llm.columns import kept_apart
from quipu.llm.common import SPACE, bound, stored, whole_text, word_list
from quipu.llm.weak import Voters, fit_voters

MIN_WORDS = 50
REPEAT_PERCENT = 50
KEEP = 0.5
PRIOR = 0.85

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_letters", "n_upper", "n_plain"]


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more: the union of those windows, first occurrences included."""
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.size(words) - 2
    )

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def twice(rows: Column) -> Column:
        same = lambda s, i: F.coalesce(F.get(rows, i)["key"] == s["key"], F.lit(False))
        places = F.transform(rows, lambda s, i: F.when(same(s, i - 1) | same(s, i + 1), s["place"]))
        return bound(F.sort_array(F.filter(places, lambda p: p.isNotNull())), covered)

    def count(keys: Column) -> Column:
        rows = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("place"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(bound(rows, twice))

    return F.when(F.size(words) < 4, 0).otherwise(bound(windows, count))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """One pass over the whole texts: COUNTS as long columns, all 0 for a null or empty text. Other columns stay."""
    rows = with_columns_once(docs, {"__text": whole_text(text)})
    rows = with_columns_once(rows, {"__words": word_list(F.col("__text"))})
    t, words = F.col("__text"), F.col("__words")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "__lines": bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))),
        "n_repeat_words": bound(words, _repeat_words),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_letters": F.length(F.regexp_replace(t, r"\P{L}+", "")),
        "n_plain": F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])")),
        "n_upper": F.length(F.regexp_replace(t, r"\P{Lu}+", "")),
    }
    rows = with_columns_once(rows, counts).drop("__text", "__words")
    rows = rows.withColumns({"n_lines": F.col("__lines.n"), "n_dup_lines": F.col("__lines.dup")}).drop("__lines")
    return rows.withColumns({c: F.col(c).cast("long") for c in COUNTS})


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes over COUNTS. A rule abstains between its two bounds and where the text is too short for it."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    symbols, letters = F.col("n_symbols") / n, F.greatest(F.col("n_letters"), F.lit(1))
    length, lines = F.col("word_chars") / n, F.greatest(F.col("n_lines"), F.lit(1))
    repeat, upper = F.col("n_repeat_words") / n, F.col("n_upper") / letters
    return {
        "long_enough": _vote(F.col("n_words") >= 2 * MIN_WORDS, F.col("n_words") < MIN_WORDS),
        "word_length": _vote(length.between(3, 12), ~length.between(2, 20)),
        "few_symbols": _vote(symbols <= 0.02, symbols >= 0.2),
        "distinct_lines": _vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") > 1), F.col("n_dup_lines") / lines > 0.3),
        "few_repeats": _vote(repeat <= 0.25, repeat > 0.5),
        "mostly_letters": _vote(letters / F.greatest(F.col("word_chars"), F.lit(1)) >= 0.85, letters / F.greatest(F.col("word_chars"), F.lit(1)) < 0.6),
        "words_with_letters": _vote(F.col("n_plain") / n <= 0.1, F.col("n_plain") / n > 0.25),
        "little_upper_case": _vote(upper <= 0.15, upper > 0.4),
        "varied_words": _vote(F.col("n_distinct") / F.sqrt(n) >= 4, F.col("n_distinct") / F.sqrt(n) < 2),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def fit(counted: DataFrame) -> Voters:
    """Rules' reliabilities, from the texts that the base conditions leave open."""
    votes = rules()
    seen = counted.filter(~base_failed()).select(*[v.alias(k) for k, v in votes.items()]).groupBy(*votes).agg(F.count("*").alias("n")).collect()
    return fit_voters({tuple(r[k] for k in votes): r["n"] for r in seen}, PRIOR)


def posterior(model: Voters) -> Column:
    """Posterior probability as an expression over COUNTS: the prior's and each vote's log odds."""
    odds = F.lit(0.0)
    if model.good:
        odds = F.lit(model.odds(tuple([0] * len(model.good))))
        for vote, g, b in zip(rules().values(), model.good, model.bad, strict=True):
            base = math.log(g[0] / b[0])
            for v in (-1, 1):
                odds = odds + F.when(vote == v, math.log(g[v] / b[v]) - base).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def vote_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without their text, with COUNTS, base_failed, quality (posterior) and kept.

    base_failed: fewer than MIN_WORDS words, or more than REPEAT_PERCENT % of the words in repeated 3-word windows. A null or empty
    text has no words and fails. Repeated rows get equal results; an empty table gives an empty result. Other columns stay; one named
    like a result comes back as <name>_before.
    """
    return kept_apart(docs, [text], lambda rows: _voted(rows, text))


def _voted(docs: DataFrame, text: str) -> DataFrame:
    counted = stored(with_counts(docs, text).drop(text), "quality-counts")
    model = fit(counted)
    rows = counted.withColumns({"base_failed": base_failed(), "quality": posterior(model)})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))
