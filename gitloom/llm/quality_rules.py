"""Quality rules: measures of a text and a table of thresholds, as built-in expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitloom.llm.common import without

# --- fixed values ---
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MARKS = "[!?]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not are this from or have an",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il",
    "de la que el en y a los del se las por un para con no una su al lo como más o pero sus le",
)
# --- end of fixed values ---


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low * of <= share <= high * of``; bounds may be open.

    ``share`` and ``of`` name measures; bounds are whole numbers per ``scale`` of ``of``.
    ``from_words`` is the length from which the rule holds.
    """

    name: str
    share: str
    of: str
    low: int | None = None
    high: int | None = None
    scale: int = 100
    from_words: int = 0


#: The default table. Whole numbers, so that no rounding decides.
RULES = (
    Rule("short_words", "word_chars", "n_words", low=200),
    Rule("long_words", "word_chars", "n_words", high=2000),
    Rule("symbols", "n_symbols", "n_words", high=15),
    Rule("marks", "n_marks", "n_words", high=40),
    Rule("stop_words", "n_stop_words", "n_words", low=2, from_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)


def _shifted(column: str, by: int):
    """The array without its last ``by`` elements, and without its first."""
    count = F.greatest(F.size(column) - by, F.lit(0))
    return F.slice(column, 1, count), F.slice(column, by + 1, count)


def _let(df: DataFrame, name: str, value: Column, *drop: str) -> DataFrame:
    return df.withColumn(name, value).drop(*drop)


def measure(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """Add a struct ``out`` of counts (all long) over the whole text; null counts as empty.

    ``n_words, word_chars, n_symbols, n_marks, n_stop_words, n_lines`` (with a word),
    ``n_dup_lines`` (equal to an earlier one) and ``n_repeat_words`` (words in windows of
    eight that occur twice or more). Each step is a projection of its own, so that arrays
    read more than once are computed once. Other columns and repeated rows pass; a column
    named ``out`` is replaced.
    """
    df = without(docs, out).withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = df.withColumn("__words", F.array_remove(F.split("__text", WORD_BREAK), ""))
    df = df.withColumn(
        "__lines", F.filter(F.split("__text", "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    )
    stop = sorted({w for line in STOP_WORDS for w in line.split()})
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.concat_ws("", "__words")),
        "n_symbols": F.length("__text") - F.length(F.regexp_replace("__text", SYMBOLS, "")),
        "n_marks": F.length("__text") - F.length(F.regexp_replace("__text", MARKS, "")),
        "n_stop_words": F.size(F.filter("__words", lambda w: F.lower(w).isin(stop))),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
    }
    df = df.withColumn("__counts", F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]))
    # Hashes of single words, then of runs of two, four and eight.
    hashed = F.transform("__words", lambda w: F.xxhash64(w))
    df = _let(df, "__h1", hashed, "__words", "__lines", "__text")
    for have in (1, 2, 4):
        left, right = _shifted(f"__h{have}", have)
        pair = F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))
        df = _let(df, f"__h{2 * have}", pair, f"__h{have}")
    # The rest is done for texts with a repeated window only; others have null there.
    again = F.size(F.array_distinct("__h8")) < F.size("__h8")
    placed = F.transform("__h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = _let(df, "__sorted", F.when(again, F.sort_array(placed)), "__h8")
    left, right = _shifted("__sorted", 1)
    equal = F.zip_with(left, right, lambda x, y: F.when(x.h == y.h, F.array(x.i, y.i)))
    starts = F.sort_array(F.array_distinct(F.flatten(F.array_compact(equal))))
    df = _let(df, "__starts", starts, "__sorted")
    left, right = _shifted("__starts", 1)
    steps = F.zip_with(left, right, lambda a, b: F.least(b - a, F.lit(WINDOW)).cast("long"))
    covered = F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda total, x: total + x)
    repeat = F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")
    # A later filter on the measures must not be moved below them: Spark would put the
    # expressions of all these steps into it, again and again. It never moves a filter
    # below a row number, which is what the condition reads.
    whole = F.when(F.monotonically_increasing_id() >= 0, F.struct("__counts.*", repeat))
    return _let(df, out, whole, "__starts", "__counts")


def base_failed(q: str = "quality") -> Column:
    """Too few words, or too many of them in repeated windows."""
    words, repeat = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (words < MIN_WORDS) | (repeat * 100 > words * MAX_REPEAT_PERCENT)


def rule_failed(rule: Rule, q: str = "quality") -> Column:
    share, of = F.col(f"{q}.{rule.share}") * rule.scale, F.col(f"{q}.{rule.of}")
    failed = F.lit(False)
    if rule.low is not None:
        failed = failed | (share < of * rule.low)
    if rule.high is not None:
        failed = failed | (share > of * rule.high)
    return (F.col(f"{q}.n_words") >= rule.from_words) & failed


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Add ``quality``, ``base_failed``, ``failed_rules`` (names) and ``kept``.

    One projection holds the whole table. A text without words fails the base.
    """
    df = without(measure(docs, text), "base_failed", "failed_rules", "kept")
    names = [F.when(rule_failed(r), F.lit(r.name)) for r in rules]
    df = df.withColumns(
        {"base_failed": base_failed(), "failed_rules": F.array_compact(F.array(*names))}
    )
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
