"""Quality rules: a threshold table compiled into one Spark projection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import WHITESPACE_CLASS, coded, decoded, let, words_of

# Frequent function words of the languages a corpus may hold.
STOP_WORDS = (
    "the of and to in is that for was with on as are this by "
    "de la le les des et est en un une du que qui dans pour "
    "der die das und ist von zu den mit nicht ein eine auf im sich "
    "el los las y una por con para del se no es lo al"
).split()

#: Words of a window whose repetition counts.
WINDOW = 8


class Rule(NamedTuple):
    """A text fails if ``100 * top`` is below ``low`` or above ``high`` times ``bottom``."""

    name: str
    top: str
    bottom: str
    low: int | None
    high: int | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 150, 2000),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 1, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("line_length", "n_words", "n_lines", 200, None),
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window found twice or more in the text."""

    def of_grams(grams: Column) -> Column:
        ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twins(pairs: Column) -> Column:
            same = F.filter(
                pairs,
                lambda x, k: ((k > 0) & (F.try_element_at(pairs, k)["g"] == x["g"])) | F.coalesce(F.try_element_at(pairs, k + 2)["g"] == x["g"], F.lit(False)),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        covered = F.aggregate(
            let(ordered, twins),
            start,
            lambda acc, p: F.struct((p + WINDOW).alias("end"), (acc["total"] + WINDOW - F.greatest(acc["end"] - p, F.lit(0))).alias("total")),
        )["total"]
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(covered)

    def of_words(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(grams, of_grams))

    return let(words, of_words)


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts of one text, all long."""
    own = F.coalesce(text, F.lit(""))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(own, WHITESPACE_CLASS + "+", "")),
        "n_symbols": F.length(F.regexp_replace(own, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
    }
    return {k: v.cast("long").alias(k) for k, v in counts.items()}


def _broken(rule: Rule) -> Column:
    top, bottom = F.col(rule.top) * 100, F.col(rule.bottom)
    checks = [top < bottom * rule.low] if rule.low is not None else []
    checks += [top > bottom * rule.high] if rule.high is not None else []
    return checks[0] if len(checks) == 1 else checks[0] | checks[1]


def with_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``docs`` with the column ``quality``: a struct of counts, failed rules and verdicts.

    Words are runs of characters other than blank and \\t to \\r. Fields: ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines``
    (lines with a word), ``n_stop_words``, ``failed`` (names of broken rules),
    ``base_failed`` (fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` % of them repeated) and ``kept``.

    Defined cases: a null or empty text has no words and fails the base; a very
    long text is measured whole; a text just at a threshold passes; rows are judged one by one, so repeated rows get the same verdict; other columns
    pass through (an existing ``quality`` column is replaced); an empty table
    gives an empty result.
    """
    own = {f: f"__quality_{f}" for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")}
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumns({"__quality_words": words_of(F.col("text")), "__quality_lines": lines})
    counts = measures(F.col("text"), F.col("__quality_words"), F.col("__quality_lines"))
    rest = docs.drop("quality").columns
    counted = split.select(*rest, *(counts[f].alias(own[f]) for f in own))
    base = (F.col(own["n_words"]) < min_words) | (F.col(own["n_repeat_words"]) * 100 > F.col(own["n_words"]) * max_repeat_percent)
    broken = [F.when(_broken(r._replace(top=own[r.top], bottom=own[r.bottom])), F.lit(r.name)) for r in rules]
    judged = counted.withColumns({"__quality_failed": F.array_compact(F.array(*broken)), "__quality_base": base})
    kept = ~F.col("__quality_base") & (F.size("__quality_failed") == 0)
    fields = [F.col(c).alias(f) for f, c in own.items()]
    return judged.select(*rest, F.struct(*fields, F.col("__quality_failed").alias("failed"), F.col("__quality_base").alias("base_failed"), kept.alias("kept")).alias("quality"))


def keep_quality(docs: DataFrame, **options) -> DataFrame:
    """The rows whose text passes, with the columns of ``docs``, whatever their names.

    Defined cases: those of :func:`with_quality`; so null and empty texts go.

    Rows are unnested from an array that is null where the text fails: a filter
    would be moved below the counts and evaluate them once per rule.
    """
    own, names = coded(docs)
    judged = with_quality(own.select(F.col(names["text"]).alias("text"), F.struct(*own.columns).alias("row")), **options)
    return decoded(judged.select(F.inline(F.when(F.col("quality.kept"), F.array("row")))), names)
