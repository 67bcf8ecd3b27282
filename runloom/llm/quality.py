"""Quality rules: a table of thresholds compiled into one projection.

Each metric is a native column expression of the text, each rule a metric with
a lower and an upper bound. All rules are evaluated in a single projection:
there is no shuffle, and a document is judged from its own row alone.

Defined results: a null or empty text has no words and fails; very long texts are
judged whole; repeated rows, equal and null ids are judged alike, each by its text;
a metric that equals a bound passes; other columns, whatever their names, are passed through by
`keep_good`; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, quoted, text_of, words_of

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to a in is that it for was on are as with by be this at from "
    "de la et le les des en un une du que qui est pour dans au par sur avec "
    "der die und das den von zu mit sich des auf für ist im nicht ein eine "
    "el y los se del las por con para su al lo como"
)
#: The symbols that count against a text.
OTHER_THAN_SYMBOLS = "[^#*$%&|<>]+"


class Rule(NamedTuple):
    metric: str
    low: float | None
    high: float | None


#: A document is kept if every metric lies within its bounds.
RULES = (
    Rule("mean_word_length", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.10),
    Rule("stop_word_ratio", 0.05, None),
    Rule("upper_ratio", None, 0.40),
    Rule("duplicate_line_ratio", None, 0.50),
    Rule("bullet_line_ratio", None, 0.90),
    Rule("ellipsis_line_ratio", None, 0.30),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


#: Bits of a window's place in its number; the others are its hash's.
PLACE = 22


def repeated_words(w: Column, n: int = 3) -> Column:
    """Words that lie in an n-word window found twice or more in the text. `w`
    is a lambda's variable that holds the words.

    A window is a number: bits of its hash above its place. Sorted as numbers,
    windows that may be equal are neighbours, so it takes m log m steps for m words
    and no pairs, however often a window repeats. Neighbours with equal bits are
    compared word by word; if two of them differ after all, or places need more
    bits, the windows themselves are sorted instead."""
    last, mask = F.size(w) - n, (1 << PLACE) - 1
    number = lambda i: F.shiftleft(F.xxhash64(*[F.get(w, i + k) for k in range(n)]), PLACE).bitwiseOR(i.cast("long"))
    place = lambda x: x.bitwiseAND(F.lit(mask)).cast("int")

    def covered(s: Column) -> Column:
        # Places of neighbours with equal bits, in pairs; of most texts there are none.
        near = lambda j: F.shiftright(F.get(s, j).bitwiseXOR(F.get(s, j + 1)), PLACE) == 0
        pairs = F.filter(F.sequence(F.lit(0), F.size(s) - 2), near)
        return F.when(F.size(s) < 2, F.lit(0)).otherwise(let(F.transform(pairs, lambda j: F.struct(place(F.get(s, j)).alias("a"), place(F.get(s, j + 1)).alias("b"))), of_pairs))

    def of_pairs(pairs: Column) -> Column:
        unlike = F.exists(pairs, lambda x: ~reduce(lambda p, q: p & q, [F.get(w, x["a"] + k) == F.get(w, x["b"] + k) for k in range(n)]))
        step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(n), p - acc["at"])).alias("n"), p.alias("at"))
        places = F.sort_array(F.flatten(F.transform(pairs, lambda x: F.array(x["a"], x["b"]))))
        total = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-n).alias("at")), step, lambda acc: acc["n"])
        return F.when(F.size(pairs) == 0, F.lit(0)).when(unlike, _by_strings(w, n)).otherwise(total)

    by_numbers = let(F.sort_array(F.transform(F.sequence(F.lit(0), last), number)), covered)
    return F.when(F.size(w) <= n, F.lit(0)).when(last > mask, _by_strings(w, n)).otherwise(by_numbers)


def _by_strings(w: Column, n: int) -> Column:
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - n),
        lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]).alias("g"), i.alias("i")),
    )

    def covered(s):
        repeats = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: (F.get(s, k)["g"] == F.coalesce(F.get(s, k + 1)["g"], F.lit("")))
            | (F.get(s, k)["g"] == F.coalesce(F.get(s, k - 1)["g"], F.lit(""))),
        )
        places = F.transform(repeats, lambda k: F.array(*[F.get(s, k)["i"] + j for j in range(n)]))
        return F.size(F.array_distinct(F.flatten(places)))

    return let(F.sort_array(windows), covered)


def counts(text: Column) -> dict[str, Column]:
    """Two structs of counts, from the words and from the lines of a text, and
    counts of characters. Words and lines are split once each."""
    # Sentence starts count too; texts all in capitals don't.
    stop_words = STOP_WORDS.split() + [x.capitalize() for x in STOP_WORDS.split()]
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(stop_words))).cast("long").alias("n_stop_words"),
    )
    of_lines = lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(x, lambda y: y.rlike(r"^\s*[-*•‣]"))).cast("long").alias("n_bullets"),
        F.size(F.filter(x, lambda y: y.rlike(r"(\.\.\.|…)\s*$"))).cast("long").alias("n_ellipses"),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "of_words": let(words_of(text), of_words),
        "of_lines": let(lines, of_lines),
        "n_symbols": F.length(F.regexp_replace(text, OTHER_THAN_SYMBOLS, "")).cast("long"),
        "n_upper": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
    }


def ratios() -> dict[str, Column]:
    """The metrics that rules look at, from the counts of `counts`."""
    over = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {
        "mean_word_length": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "stop_word_ratio": over("n_stop_words", "n_words"),
        "upper_ratio": over("n_upper", "word_chars"),
        "duplicate_line_ratio": over("n_dup_lines", "n_lines"),
        "bullet_line_ratio": over("n_bullets", "n_lines"),
        "ellipsis_line_ratio": over("n_ellipses", "n_lines"),
    }


def compile_rules(rules=RULES) -> Column:
    """One boolean column: all rules hold."""
    values, verdict = ratios(), F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict = verdict & (values[rule.metric] >= rule.low)
        if rule.high is not None:
            verdict = verdict & (values[rule.metric] <= rule.high)
    return verdict


def judge(docs: DataFrame, text: str = "text", keep=("doc_id",), rules=RULES) -> DataFrame:
    """The columns `keep`, the counts, `base_failed` and `kept`, for each row."""
    found = docs.select(*keep, *[c.alias(n) for n, c in counts(text_of(text)).items()])
    found = found.select(*keep, "of_words.*", "of_lines.*", "n_symbols", "n_upper")
    base = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )
    return found.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that every rule keeps, with their columns as they were."""
    whole = F.struct(*quoted(docs.columns))
    judged = judge(docs.select(whole.alias("_row"), F.col(text).alias("_text")), "_text", keep=("_row",))
    return judged.filter("kept").select("_row.*")
