"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds one measure of a whole text. Measures and verdict are built-in functions
only, so a scan, one projection and nothing else: no shuffle, no user function, and memory
bounded by the longest text.

Defined results: a null text counts as empty; an empty text has no words and fails; repeated
rows are judged alike; other columns, whatever their names, pass through untouched where the
operator keeps rows (`keep`). A rule whose measure is null (a ratio over nothing) passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.bind import WHITE, bind, count_chars, words_of

# Frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it as for on with by this be are or an at from was not "
    "de la le les et en un une des du que qui pour par est dans sur au "
    "der die das und ist nicht von zu mit den ein eine im für sich auf "
    "el los las y se por con para del es su como"
).split()

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A measure and the closed range it has to lie in; `least_words`: shorter texts pass."""

    measure: str
    low: float | None = None
    high: float | None = None
    least_words: int = 0


RULES = (
    Rule("n_words", low=10, high=200_000),
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("symbols_per_word", high=0.1),
    Rule("shouts_per_word", high=0.2),
    Rule("upper_share", high=0.3),
    Rule("stop_word_share", low=0.02, least_words=50),
    Rule("dup_line_share", high=0.4),
    Rule("echo_share", high=0.2),
    Rule("repeat_share", high=0.2),
)


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five words that is found twice or more in the text."""

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, j: F.coalesce(F.least(F.lit(WINDOW), p - F.get(places, j - 1)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            return F.sort_array(
                F.array_compact(
                    F.transform(
                        rows,
                        lambda row, j: F.when(
                            (row["h"] == F.get(rows, j - 1)["h"]) | (row["h"] == F.get(rows, j + 1)["h"]),
                            row["i"],
                        ),
                    )
                )
            )

        # Most texts repeat no window; they are done after one hashed count.
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            bind(placed, lambda rows: bind(repeated(rows), covered)),
        ).otherwise(F.lit(0).cast("bigint"))

    def windows_of(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return bind(hashes, lambda h: bind(windows_of(h), of_windows))


def _measures(text: Column, words: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, WHITE + " ", "") != "")
    plain = F.transform(words, lambda w: F.translate(F.lower(w), ".,;:!?\"'()", ""))
    count = F.size(words).cast("bigint")
    return F.struct(
        count.alias("n_words"),
        F.length(F.translate(text, WHITE + " ", "")).cast("bigint").alias("word_chars"),
        count_chars(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        F.size(lines).cast("bigint").alias("n_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        count_chars(text, "!").cast("bigint").alias("n_shouts"),
        F.length(F.regexp_replace(text, r"[^A-ZÀ-ÖØ-Þ]++", "")).cast("bigint").alias("n_upper"),
        F.size(F.filter(plain, lambda w: w.isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("bigint").alias("n_echoes"),
    )


def measures(text: Column) -> Column:
    """Counts over a whole text as one struct."""
    whole = F.coalesce(text, F.lit(""))
    return bind(
        F.struct(whole.alias("text"), words_of(whole).alias("words")),
        lambda x: _measures(x["text"], x["words"]),
    )


def _ratios(m: Column) -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(m[whole] > 0, m[part] / m[whole])

    return {
        "n_words": m["n_words"].cast("double"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "shouts_per_word": share("n_shouts", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "stop_word_share": share("n_stop_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "echo_share": share("n_echoes", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
    }


def compiled(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The whole table as one condition over a measures struct."""
    ratios = _ratios(m)
    verdict = F.lit(True)
    for rule in rules:
        value, ok = ratios[rule.measure], F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= F.lit(rule.low))
        if rule.high is not None:
            ok = ok & (value <= F.lit(rule.high))
        if rule.least_words:
            ok = ok | (m["n_words"] < rule.least_words)
        verdict = verdict & F.coalesce(ok, F.lit(True))
    return verdict


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, and whether the row is kept."""
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"))
    failed = base_failed(F.col("m"))
    return measured.select(
        "doc_id", "m.*", failed.alias("base_failed"), (~failed & compiled(F.col("m"), rules)).alias("kept")
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, all their columns as they came."""

    def verdict(m: Column) -> Column:
        return ~base_failed(m) & compiled(m, rules)

    return docs.filter(bind(measures(F.col("text")), verdict))
