"""Text expressions, including the places where SQL and Python habits differ."""

from pyspark.sql import functions as F

from gitloom.functions import text as tx
from gitloom.operators.file_diffs import explode_files

TWO_FILES = (
    "diff --git a/x.py b/y.py\nsimilarity index 90%\nrename from x.py\nrename to y.py\n"
    "index 111..222 100644\n--- a/x.py\n+++ b/y.py\n@@ -1 +1 @@\n-a\n+b\n"
    "diff --git a/n.txt b/n.txt\nnew file mode 100644\nindex 000..333\n--- /dev/null\n+++ b/n.txt\n@@ -0,0 +1 @@\n+new  \n\n"
)


def check(spark, cases, expression):
    """All cases in one job."""
    df = spark.createDataFrame([(i, case[0]) for i, case in enumerate(cases)], "i int, v string")
    got = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [case[1] for case in cases]


def test_file_pieces(spark):
    cases = [
        (None, []),
        ("", []),
        (" \n\t", []),
        (TWO_FILES, ["--- a/x.py\n+++ b/y.py\n@@ -1 +1 @@\n-a\n+b", "--- /dev/null\n+++ b/n.txt\n@@ -0,0 +1 @@\n+new"]),
        # two files without boundary lines stay one piece
        ("--- a/p\n+++ b/p\n--- a/q\n+++ b/q", ["--- a/p\n+++ b/p\n--- a/q\n+++ b/q"]),
        # carriage returns inside survive, at the end they are stripped
        ("diff --git a b\n+x\r\n+y\r\n", ["+x\r\n+y"]),
        # a pure rename leaves nothing
        ("diff --git a b\nsimilarity index 100%\nrename from a\nrename to b\n", []),
        # the header of a root commit is a piece of its own
        ("commit 1\nAuthor: x\n\ndiff --git a b\n+z", ["commit 1\nAuthor: x", "+z"]),
        # a blank first line belongs to the piece before any boundary
        ("\nfoo\ndiff --git a b\n\n+z", ["\nfoo", "\n+z"]),
        # kept: lines that only look like metadata
        ("diff --git a b\nold mode 1\nBinary files a and b differ\nindexed", ["old mode 1\nBinary files a and b differ\nindexed"]),
        ("diff --git a b\n+a b\n+c\x85d", ["+a b\n+c\x85d"]),
    ]
    check(spark, cases, tx.file_pieces)


def test_explode_keeps_commits_without_files(spark):
    df = spark.createDataFrame([("c1", TWO_FILES), ("c2", ""), ("c3", "commit 1\ndiff --git a b\n+++ b/z")], "h string, diff string")
    rows = [(r.h, r.file_ord, r.diff) for r in explode_files(df).orderBy("h", "file_ord").collect()]
    assert [r[:2] for r in rows] == [("c1", 0), ("c1", 1), ("c2", 0), ("c3", 0), ("c3", 1)]
    assert rows[2][2] == ""
    kept = explode_files(df.where("h = 'c3'"), drop_preamble=True).collect()
    assert [r.diff for r in kept] == ["+++ b/z"]


def test_repo_id(spark):
    cases = [
        ("https://host/owner/repo", "owner/repo"),
        ("https://host/owner/repo///", "owner/repo"),
        ("owner/repo", "owner/repo"),
    ]
    check(spark, cases, tx.repo_id_from_url)


def test_hash_tokens(spark):
    cases = [
        ("fixes abc1234 and ABCDEF12, abc1234 again", ["abc1234", "ABCDEF12"]),
        ("a" * 40, ["a" * 40]),
        ("a" * 41, []),
        ("abc123", []),
        ("_abc1234 éabc1234 gabc1234", []),
        (None, []),
        ("", []),
    ]
    check(spark, cases, tx.commit_hash_tokens)


def test_strip_is_unicode(spark):
    raw = ["\t x  　", "\x1cx\x1f", "x", "\xa0x\x85\r\n"]
    assert all(r.strip() == "x" for r in raw)
    check(spark, [(r, "x") for r in raw], tx.strip)


def test_diff_file_path(spark):
    cases = [
        ("--- a/old.py\n+++ b/new.py\n", "old.py"),
        ("--- /dev/null\n+++ b/new.py\n@@", "new.py"),
        ("x\x0b--- a/v\x0cmore", "v"),
        ("no header", "unknown_7"),
        ("+--- a/quoted", "unknown_7"),
        ("--- a/with space.txt\r\n", "with space.txt"),
    ]
    check(spark, cases, lambda d: tx.diff_file_path(d, F.lit(7)))


def test_blank_diff(spark):
    cases = [("", True), (None, True), (" NaN\n", True), ("None", True), ("nano", False)]
    check(spark, cases, tx.is_blank_diff)


def test_truncate(spark):
    cases = [("abcdef", "abc" + tx.TRUNCATION_MARK), ("abc", "abc")]
    check(spark, cases, lambda d: tx.truncate_diff(d, 3))


def test_sanitize_replaces_only_invalid(spark):
    df = spark.sql("select cast(X'61FF62' as string) as bad, 'keep � é' as good")
    row = df.select(tx.sanitize_utf8(F.col("bad")).alias("b"), tx.sanitize_utf8(F.col("good")).alias("g")).first()
    assert row.b == "a?b" and row.g == "keep � é"


def test_bigrams(spark):
    cases = [
        ("Fix the parser, fix the lexer", ["fix the", "parser fix", "the lexer", "the parser"]),
        ("a b c", []),
        ("single", []),
        (None, []),
        ("", []),
        ("Über die_Brücke x gehen", ["die_brücke gehen", "über die_brücke"]),
    ]
    check(spark, cases, tx.bigrams)


def test_pr_search_text(spark):
    df = spark.createDataFrame([("t", None), ("", "b"), (None, "b"), ("t", "b")], "t string, b string")
    rows = df.select(tx.pr_search_text(F.col("t"), F.col("b")).alias("r")).collect()
    assert [r.r for r in rows] == ["t ", "b", "b", "t b"]
