"""Text expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal what str.strip / str.splitlines treat as space or break ---
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
LINE_BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}"
# Git lines that are no part of a file's own diff text.
DIFF_BOUNDARY = "diff --git"
DIFF_METADATA = (
    "similarity index",
    "rename from",
    "rename to",
    "index ",
    "new file mode",
    "deleted file mode",
)
COMMIT_HASH_TOKEN = r"(?iU)\b[0-9a-f]{7,40}\b"
WORD_TOKEN = r"(?U)\w{2,}"  # the maximal runs of two or more word characters
TRUNCATION_MARK = "\n\n[... DIFF TRUNCATED ...]"
BLANK_WORDS = ("nan", "none")
# --- end of fixed values ---


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), F.lit(1))


def strip(text: Column) -> Column:
    """Remove all Unicode white space at both ends (SQL ``trim`` drops spaces only)."""
    return F.trim(text, F.lit(WHITESPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    return F.coalesce(strip(text) != "", F.lit(False))


def repo_id_from_url(url: Column) -> Column:
    """``owner/repo``: the last two parts of the URL without trailing slashes."""
    parts = F.split(F.rtrim(url, F.lit("/")), "/")
    return F.concat_ws("/", F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1)))


def file_pieces(diff: Column) -> Column:
    """Array with one text per changed file of a unified diff; empty when blank.

    ``(?md)`` makes ``^ $ .`` treat only ``\\n`` as a line end, so ``\\r`` survives.
    """
    metadata = "(?md)^(?:" + "|".join(DIFF_METADATA) + r").*\n?"

    def clean(piece: Column, position: Column) -> Column:
        # After a boundary the piece starts with that line's own line end.
        body = F.when(position > 0, F.regexp_replace(piece, r"\A\n", "")).otherwise(piece)
        return rstrip(F.regexp_replace(body, metadata, ""))

    pieces = F.transform(F.split(diff, f"(?md)^{DIFF_BOUNDARY}.*$"), clean)
    return F.when(has_text(diff), F.filter(pieces, lambda p: p != "")).otherwise(
        F.array().cast("array<string>")
    )


def commit_hash_tokens(text: Column) -> Column:
    """Distinct 7-40 digit hex words of a text, as written."""
    return F.coalesce(
        F.array_distinct(F.regexp_extract_all(text, F.lit(COMMIT_HASH_TOKEN), F.lit(0))),
        F.array().cast("array<string>"),
    )


def pr_search_text(title: Column, body: Column) -> Column:
    head = F.when(F.coalesce(title, F.lit("")) != "", F.concat(title, F.lit(" "))).otherwise("")
    return F.concat(head, F.coalesce(body, F.lit("")))


def sanitize_utf8(text: Column) -> Column:
    """Replace what is not valid UTF-8 by ``?``; valid texts pass unchanged."""
    repaired = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("?"))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def is_blank_stripped(stripped: Column) -> Column:
    """Nothing, or a word that stands for a missing value (only short texts are compared)."""
    longest = max(map(len, BLANK_WORDS))
    return (stripped == "") | F.lower(F.left(stripped, F.lit(longest + 1))).isin(*BLANK_WORDS)


def is_blank_diff(diff: Column) -> Column:
    return is_blank_stripped(strip(F.coalesce(diff, F.lit(""))))


def stripped_file_path(stripped: Column, fallback: Column) -> Column:
    """Path on the first ``--- a/`` or ``+++ b/`` line; ``unknown_<n>`` when there is none.

    The mark before the path tells an empty path from none with one pass of the pattern.
    """
    pattern = f"(?:\\A|[{LINE_BREAKS}])((?:--- a/|\\+\\+\\+ b/)[^{LINE_BREAKS}]*)"

    def path(found: Column) -> Column:
        named = F.substring(found, len("--- a/") + 1, F.length(found))
        return F.when(found != "", named).otherwise(
            F.concat(F.lit("unknown_"), fallback.cast("string"))
        )

    return let(F.regexp_extract(stripped, pattern, 1), path)


def diff_file_path(diff: Column, fallback: Column) -> Column:
    return stripped_file_path(strip(diff), fallback)


def truncate_diff(diff: Column, limit: int) -> Column:
    return F.when(
        F.length(diff) > limit, F.concat(F.left(diff, F.lit(limit)), F.lit(TRUNCATION_MARK))
    ).otherwise(diff)


def summary_line(file_path: Column, summary: Column) -> Column:
    return F.concat(F.lit("- "), file_path, F.lit(": "), summary)


def short_hash(commit_hash: Column) -> Column:
    return F.left(commit_hash, F.lit(8))


def bigram_set(text: Column) -> Column:
    """Distinct adjacent word pairs in order of appearance; empty for null and one-word texts."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), F.lit(0))

    def pairs(words: Column) -> Column:
        # The list zipped with itself shifted by one: linear in the text.
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.array_distinct(
            F.zip_with(
                F.slice(words, F.lit(1), n),
                F.slice(words, F.lit(2), n),
                lambda a, b: F.concat(a, F.lit(" "), b),
            )
        )

    return F.coalesce(let(tokens, pairs), F.array().cast("array<string>"))


def bigrams(text: Column) -> Column:
    """:func:`bigram_set`, sorted."""
    return F.sort_array(bigram_set(text))
