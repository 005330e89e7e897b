"""Quality rules: a table of thresholds compiled into one Spark projection.

Every rule compares a ratio of two counted metrics with a bound, in integers
(``numerator * q`` against ``denominator * p`` for the bound p/q), so nothing depends on
floating-point rounding. The metrics are built-in expressions on the text; there is no
user function, no join and no shuffle: each row is judged where it is read.

Words repeated in three-word windows are found inside the row: the windows' hashes are
sorted together with their positions, equal neighbours are repeated windows, and the words
that they cover are counted by the distance from one start to the next. That is
n log n in the words of one text and needs no frequency table beyond the row. (Windows are
compared by two independent 64-bit and 32-bit hashes.)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import fraction, let, masked, space_words, unmasked, without

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "be", "at", "by", "this", "are", "a",
    "der", "die", "und", "das", "ist", "nicht", "ein", "eine", "zu", "den", "mit", "von", "auf", "im",
    "le", "la", "les", "des", "et", "est", "un", "une", "du", "que", "qui", "dans", "pour", "pas", "de",
    "el", "los", "las", "que", "y", "en", "por", "con", "para", "se", "su", "una", "no", "es",
)
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Reject when ``metric / per`` is below ``low`` or above ``high`` (None: no bound)."""
    name: str
    metric: str
    per: str
    low: float | None = None
    high: float | None = None


# Thresholds as published for web text (mean word length, symbols and repeated lines per
# word and line), the stop-word bound as a ratio.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2, 15),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.3),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
)
# The base rules of the contract, in the same form.
BASE_RULES = (
    Rule("too_short", "n_words", "one", 50, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
)


def violated(rule: Rule) -> Column:
    """True where the rule rejects; a denominator of 0 rejects only under a lower bound above 0."""
    tests = []
    for bound, worse in ((rule.low, "lt"), (rule.high, "gt")):
        if bound is not None:
            p, q = fraction(bound)
            left, right = F.col(rule.metric) * F.lit(q), F.col(rule.per) * F.lit(p)
            tests.append(left < right if worse == "lt" else left > right)
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _repeat_words(sorted_windows: Column, n_words: Column) -> Column:
    """Words covered by windows whose hash occurs twice, from the sorted (hash, hash, start)."""
    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda a, b: (a.h == b.h) & (a.g == b.g)
        twice = F.filter(s, lambda x, k: F.coalesce((k > 0) & same(F.get(s, F.greatest(k - 1, F.lit(0))), x), F.lit(False))
                         | F.coalesce((k < last) & same(F.get(s, F.least(k + 1, last)), x), F.lit(False)))
        return let(F.array_sort(F.transform(twice, lambda x: x.i)), spans)

    def spans(at: Column) -> Column:
        steps = F.zip_with(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))),
                           F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(3)))
        return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(3), lambda t, x: t + x))

    return F.when(n_words < 3, F.lit(0)).otherwise(let(sorted_windows, covered)).cast("long")


def measure(docs: DataFrame, text_col: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Add the metrics to every row: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_stop_words (all long). A null text has no words and no lines."""
    docs, names = masked(docs)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    start = docs.select("*", space_words(text).alias("__w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    hashed = start.select("*", F.when(F.size("__w") >= 3, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("__w") - 2, F.lit(1))),
        lambda i: F.struct(F.xxhash64(*[F.try_element_at("__w", i + k) for k in range(3)]).alias("h"),
                           F.hash(*[F.try_element_at("__w", i + k) for k in range(3)]).alias("g"),
                           i.alias("i")))).alias("__h"))
    lowered = F.transform("__w", lambda x: F.lower(x))
    metrics = F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.sort_array("__h"), F.size("__w")).alias("n_repeat_words"),
        F.size(F.filter(lowered, lambda x: x.isin(*dict.fromkeys(stop_words)))).cast("long").alias("n_stop_words"),
        F.lit(1).cast("long").alias("one"))
    # as the rows of a generator the metrics are computed once per text: a filter on a verdict
    # would otherwise be pushed below the projection with a copy of each metric's expression
    return hashed.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(metrics)).alias("__m")).select(
        *unmasked(names), "__m.*")


METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


def judge(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
          base_rules: Sequence[Rule] = BASE_RULES, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Every row of ``docs`` with the metrics, ``base_failed``, ``failed_rules`` (names, in the
    table's order) and ``kept``.

    Columns of ``docs`` that have the name of a result column are replaced by it. Null and
    empty texts have 0 words and fail as too short; an empty table gives an empty result;
    repeated rows each get the same result."""
    rows = without(docs, (*METRICS, "one", "base_failed", "failed_rules", "kept"), [text_col])
    m = measure(rows, text_col, stop_words)
    base = F.lit(False)
    for r in base_rules:
        base = base | violated(r)
    failed = F.array_compact(F.array(*[F.when(violated(r), F.lit(r.name)) for r in (*base_rules, *rules)]))
    return (m.withColumns({"base_failed": base, "failed_rules": failed})
            .withColumn("kept", F.size("failed_rules") == 0).drop("one"))
