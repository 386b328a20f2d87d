"""URL rules and a blocked Bloom filter in front of an exact join, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitloom.llm.bloom import blocks_for, build_filter, possible_hits
from gitloom.llm.common import without
from gitloom.session import cut_measured

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
#: What makes a page bad: a word of its host, too few words, too many repeated paragraphs
#: (the bounds that quality rules for web text commonly take).
SPAM_HOST = r"\bspam\b"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 30


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host and the path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host and path without closing slashes; null where there is no host."""
    return F.when(host != "", F.concat(host, F.rtrim(path, F.lit("/"))))


def rule_of(rules: Sequence[UrlRule], host: Column, path: Column, value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.lit(getattr(r, value)),
        )
        for r in ordered
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def bad_pages(
    pages: DataFrame,
    spam_host: str = SPAM_HOST,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
) -> DataFrame:
    """``url`` of the pages (``url, html``) whose host or content is bad, a list to block.

    Bad is a host that ``spam_host`` finds, an article of fewer than ``min_words`` words, or
    one of whose paragraphs more than ``max_repeated_percent`` repeat an earlier one. The
    article is what ``<article>`` holds, or else the whole html; null html has no words. Null
    urls and urls without a host pass and block nothing; repeated rows stay.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    inside = F.split_part(F.split_part(html, F.lit("<article>"), F.lit(2)), F.lit("</article>"), F.lit(1))
    article = F.coalesce(F.nullif(inside, F.lit("")), html)
    split = pages.select("url", host_and_path(F.col("url"))[0].alias("host"), article.alias("article"))
    words = F.regexp_count(F.regexp_replace("article", "<[^>]*>", " "), F.lit(WORD))
    parts = F.split("article", "<p>")
    repeated = F.size(parts) - F.size(F.array_distinct(parts))
    too_many = 100 * repeated > max_repeated_percent * F.size(parts)
    return split.where(F.col("host").rlike(spam_host) | (words < min_words) | too_many).select("url")


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[UrlRule] = (),
    url: str = "url",
    blocks: int | None = None,
) -> DataFrame:
    """Add ``host, path, rule, verdict``; ``listed`` has urls to block in its column ``url``.

    The longest rule that fits decides. Where none fits, a url whose canonical form is
    listed is blocked and all others are allowed, those without a host included. Repeated
    rows stay, and a url listed twice counts once; an empty list blocks nothing. Columns of
    the added names are replaced. The canonical forms of the list are a stored table, and
    the filter is sized by their number unless ``blocks`` is given. Rows that it clears take
    no part in the join; a url that a third of the rows share is a skewed join that Spark
    splits.
    """
    base = without(pages, "host", "path", "rule", "verdict")
    host, path = host_and_path(F.col(f"`{url}`"))
    split = base.withColumns({"host": host, "path": path})
    ruled = split.withColumns(
        {
            "rule": rule_of(rules, F.col("host"), F.col("path"), "text"),
            "verdict": rule_of(rules, F.col("host"), F.col("path"), "verdict"),
            "__key": canonical(F.col("host"), F.col("path")),
        }
    )
    l_host, l_path = host_and_path(F.col("url"))
    keys = listed.select(canonical(l_host, l_path).alias("__key")).where("__key is not null").distinct()
    bad, seen = cut_measured(keys, "listed", n=F.count(F.lit(1)))
    blocks = blocks or blocks_for(seen["n"])
    built = build_filter(bad, "__key", blocks)
    # Only urls that no rule decides are looked up.
    probed = possible_hits(ruled, "__key", built, blocks)
    probed = probed.withColumn("__possible", F.col("__possible") & F.col("rule").isNull())
    allowed = F.coalesce("verdict", F.lit("allow"))
    clear = probed.where(~F.col("__possible")).withColumn("verdict", allowed)
    asked = probed.where("__possible").join(bad.withColumn("__listed", F.lit(True)), "__key", "left")
    found = F.when(F.col("__listed"), "block").otherwise("allow")
    asked = asked.withColumn("verdict", found).drop("__listed")
    return clear.unionByName(asked).drop("__key", "__possible")
