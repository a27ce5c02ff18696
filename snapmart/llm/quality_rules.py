"""Quality rules as weak supervision, on DataFrame functions alone.

Each rule votes good (1) or bad (0) or abstains (null) from a document's own statistics. How far a rule can be
trusted is not set by hand: expectation-maximisation on the counts of all vote patterns of the corpus estimates for
each rule how often it votes either way on good and on bad documents, and a document is kept if its posterior
probability of being good is at least one half.

A report keeps the statistics in a written table; a filter reads the texts twice, once for the pattern counts and once
for the verdicts. Nothing of a text is shuffled. Only
the pattern counts (at most 3 ** number of rules rows, whatever the corpus) reach the driver.

Null and empty texts have no words; all counts are 0 and the document fails the base rules. Repeated rows are judged
alike, each on its own. Other columns pass through untouched; helper columns carry a reserved prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import written

#: Prefix of helper columns, which are dropped again.
_P = "__quality_"

#: Windows of so many words that come twice make their words repeated ones.
WINDOW = 3

#: Rounds of expectation-maximisation, and the weight of what is believed beforehand as a share of all documents, so
#: that corpora of any size are judged alike.
ROUNDS, PRIOR_WEIGHT = 60, 0.5

#: Belief before any document is seen: share of good documents, and how often a rule finds fault with a bad and with
#: a good document. A bad document seldom breaks more than a rule or two, so a good vote says little; a bad one much.
PRIOR_GOOD, PRIOR_CAUGHT, PRIOR_FALSE = 0.7, 0.3, 0.01


def _c(name: str) -> Column:
    return F.col(f"`{_P}{name}`")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the helper columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_upper, n_letters and n_marks."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.withColumns(
        {
            f"{_P}words": F.array_remove(F.split(value, r"[\x20\x09-\x0D]+", -1), ""),
            f"{_P}lines": F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            f"{_P}word_chars": F.length(F.regexp_replace(value, r"[\x20\x09-\x0D]+", "")).cast("long"),
            f"{_P}n_symbols": (F.length(value) - F.length(F.regexp_replace(value, r"[#*$%&|<>]+", ""))).cast("long"),
            f"{_P}n_upper": (F.length(value) - F.length(F.regexp_replace(value, r"\p{Lu}+", ""))).cast("long"),
            f"{_P}n_letters": (F.length(value) - F.length(F.regexp_replace(value, r"\p{L}+", ""))).cast("long"),
            f"{_P}n_marks": (F.length(value) - F.length(F.regexp_replace(value, r"[!?]+", ""))).cast("long"),
        }
    )
    words = _c("words")
    out = out.withColumns(
        {
            f"{_P}n_words": F.size(words).cast("long"),
            f"{_P}n_lines": F.size(_c("lines")).cast("long"),
            f"{_P}n_dup_lines": (F.size(_c("lines")) - F.size(F.array_distinct(_c("lines")))).cast("long"),
            f"{_P}windows": F.when(
                F.size(words) > WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                    lambda i: F.xxhash64(*[F.element_at(words, (i + k).cast("int")) for k in range(WINDOW)]),
                ),
            ),
        }
    )
    windows = _c("windows")
    # Only a text in which some window comes twice pays for the sort.
    out = out.withColumn(
        f"{_P}sorted",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    ordered = _c("sorted")
    out = out.withColumn(
        f"{_P}starts",
        F.array_sort(
            F.filter(
                F.transform(
                    ordered,
                    lambda x, i: F.when(
                        (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]), x["i"]
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ),
    )
    # A repeated window covers its words up to the next repeated window, and all of them if none follows.
    starts = _c("starts")
    covered = F.aggregate(
        F.transform(
            starts, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW)))
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    out = out.withColumn(f"{_P}n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return out.drop(*[f"{_P}{x}" for x in ("words", "lines", "windows", "sorted", "starts")])


def base_failed() -> Column:
    return (_c("n_words") < 50) | (100 * _c("n_repeat_words") > 50 * _c("n_words"))


def _vote(bad: Column, good: Column, known: Column | None = None) -> Column:
    vote = F.when(bad, 0).when(good, 1)
    return vote if known is None else F.when(known, vote)


def votes() -> dict[str, Column]:
    """The rules. Thresholds leave a gap between good and bad in which a rule abstains."""
    n = _c("n_words")
    some = n > 0
    return {
        "length": _vote(n < 50, n >= 80),
        "repeats": _vote(2 * _c("n_repeat_words") > n, 5 * _c("n_repeat_words") < n, some),
        "symbols": _vote(8 * _c("n_symbols") > n, 12 * _c("n_symbols") < n, some),
        "lines": _vote(
            10 * _c("n_dup_lines") > 3 * _c("n_lines"), 10 * _c("n_dup_lines") < _c("n_lines"), _c("n_lines") > 2
        ),
        "word_length": _vote(
            (_c("word_chars") < 2 * n) | (_c("word_chars") > 15 * n),
            (_c("word_chars") >= 3 * n) & (_c("word_chars") <= 12 * n),
            some,
        ),
        "letters": _vote(
            100 * _c("n_letters") < 87 * _c("word_chars"), 100 * _c("n_letters") > 92 * _c("word_chars"), some
        ),
        "capitals": _vote(2 * _c("n_upper") > _c("word_chars"), 5 * _c("n_upper") < _c("word_chars"), some),
        "marks": _vote(2 * _c("n_marks") > n, 5 * _c("n_marks") < n, some),
    }


def fit(patterns: list[tuple[tuple[int | None, ...], int]]) -> tuple[float, list[dict[int, float]]]:
    """Log odds of a good document, and what each rule's vote adds to them.

    The two classes start from the beliefs above, which also stay as evidence of the weight `PRIOR_WEIGHT`; so the
    classes can't become something else than good and bad on a corpus where few documents are bad. An abstention adds nothing.
    """
    rules = len(patterns[0][0]) if patterns else 0
    good = PRIOR_GOOD
    believed = (1 - PRIOR_CAUGHT, 1 - PRIOR_FALSE)
    up = [list(believed) for _ in range(rules)]  # up[rule][class]: a vote on a document of the class is 1

    def weights() -> tuple[float, list[dict[int, float]]]:
        add = [{1: math.log(u[1] / u[0]), 0: math.log((1 - u[1]) / (1 - u[0]))} for u in up]
        return math.log(good / (1 - good)), add

    weight = PRIOR_WEIGHT * max(1, sum(count for _, count in patterns))
    for _ in range(ROUNDS):
        bias, add = weights()
        seen = [[[weight * (1 - p), weight * p] for p in believed] for _ in range(rules)]
        share, total = weight * PRIOR_GOOD, weight
        for pattern, count in patterns:
            odds = bias + sum(add[r][v] for r, v in enumerate(pattern) if v is not None)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            share, total = share + count * p, total + count
            for r, v in enumerate(pattern):
                if v is not None:
                    seen[r][0][v] += count * (1 - p)
                    seen[r][1][v] += count * p
        good = share / total
        up = [[one / (zero + one) for zero, one in s] for s in seen]
    return weights()


def with_posterior(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """`rows` and posterior (probability of a good document); both have statistics, those of `stats` are learned from."""
    rules = votes()
    counted = (
        stats.select(*[rule.alias(f"r{i}") for i, rule in enumerate(rules.values())])
        .groupBy(*[f"r{i}" for i in range(len(rules))])
        .count()
        .collect()
    )
    bias, add = fit(sorted(((tuple(r)[:-1], r["count"]) for r in counted), key=repr))
    odds = F.lit(bias)
    for rule, vote in zip(rules.values(), add or [{0: 0.0, 1: 0.0}] * len(rules), strict=True):
        odds = odds + F.when(rule == 1, F.lit(vote[1])).when(rule == 0, F.lit(vote[0])).otherwise(F.lit(0.0))
    return rows.withColumn(f"{_P}posterior", 1 / (1 + F.exp(-odds)))


def kept() -> Column:
    return ~base_failed() & (_c("posterior") >= 0.5)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: statistics, base_failed, kept and the posterior."""
    stats = written(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality")
    return with_posterior(stats, stats).select(
        "doc_id",
        *[_c(x).alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"),
        kept().alias("kept"),
        F.round(_c("posterior"), 6).alias("posterior"),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns, whatever their names.

    Texts are counted once: the rows are written with their statistics, from which the rules are learned and applied.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(f"{_P}row")
    rows = with_statistics(docs.select(row, F.col(f"`{text}`").alias("text"))).drop("text")
    rows = written(rows, "quality")
    return with_posterior(rows, rows).where(kept()).select(f"{_P}row.*")
