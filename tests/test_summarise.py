"""Model stages: retries, isolation of failures, resume, reduction."""

import os

from pyspark.sql import functions as F

from gitloom.operators.inference import Model, infer, stub_model
from gitloom.operators.summarise import FAILED_FILE, NO_CHANGES, commits_per_hash, synthesise
from gitloom.plans import summarise as plan
from gitloom.schemas import FILE_DIFFS
from gitloom.session import scratch_path


def logging_client(log, answer):
    """A client that appends one line per prompt to ``log``."""

    def factory():
        def client(prompts):
            with open(log, "a") as f:
                f.writelines("call\n" for _ in prompts)
            return [answer(p) for p in prompts]

        return client

    return Model("test", client=factory)


def calls(log):
    return sum(1 for _ in open(log)) if os.path.exists(log) else 0


def test_retries_and_isolation(spark, tmp_path):
    log = str(tmp_path / "log")

    def answer(prompt):
        if prompt == "boom":
            raise RuntimeError("down")
        if prompt == "twice" and calls(log) < 8:
            return ""
        return '{"k": "' + prompt + '"}'

    df = spark.createDataFrame([("a",), ("boom",), ("twice",)], "p string").coalesce(1)
    rows = {r.p: r for r in infer(df, "p", "k", logging_client(log, answer)).collect()}
    # the failed list call was the first attempt of all three prompts
    assert (rows["a"].value, rows["a"].attempts, rows["a"].status) == ("a", 2, "completed")
    assert (rows["boom"].value, rows["boom"].attempts, rows["boom"].status) == (None, 3, "failed")
    assert "down" in rows["boom"].error
    assert rows["twice"].status == "completed" and rows["twice"].attempts > 1


def test_wrong_number_of_replies_is_a_failure(spark):
    model = Model("short", client=lambda: (lambda prompts: []))
    df = spark.createDataFrame([("a",)], "p string")
    assert infer(df, "p", "k", model, max_retries=1).first().status == "failed"


def files(spark, *rows):
    return spark.createDataFrame(
        [("o/r", h, 0, n, f"message {h}", d, None, None) for h, n, d in rows], FILE_DIFFS
    )


ROWS = [
    ("abc", 0, "--- a/one.py\n+1"), ("abc", 1, "--- a/two.py\n+2"), ("abc", 2, " "),
    ("def", 0, "--- a/three.py\n+3"), ("empty", 0, ""),
]


def test_second_run_calls_nothing_and_failures_are_tried_again(spark, tmp_path):
    file_log, commit_log, out = str(tmp_path / "f"), str(tmp_path / "c"), str(tmp_path / "out")
    broken = tmp_path / "broken"
    broken.write_text("")

    def answer_commit(prompt):
        if "message def" in prompt and broken.exists():
            return "no json"
        return '{"semantic_summary": "' + ("both" if "one.py" in prompt else "single") + '"}'

    file_model = logging_client(file_log, lambda p: '{"file_summary": "changed"}')
    commit_model = logging_client(commit_log, answer_commit)
    df = files(spark, *ROWS)
    assert plan.run(spark, df, out, file_model, commit_model) == {"processed": 2, "skipped": 0, "failed": 1}
    assert calls(file_log) == 3
    assert calls(commit_log) == 1 + 3  # the failing commit takes three attempts
    stage = spark.read.parquet(f"{out}/file_summaries").collect()
    assert [r.commit_hash for r in stage] == ["def"]  # finished commits left the stage
    broken.unlink()
    assert plan.run(spark, df, out, file_model, commit_model) == {"processed": 1, "skipped": 2, "failed": 0}
    assert calls(file_log) == 3  # the stored file summary is used
    got = {r.commit_hash: r.semantic_summary for r in spark.read.parquet(f"{out}/summaries").collect()}
    assert got == {"abc": "both", "def": "single", "empty": NO_CHANGES}
    assert not os.path.exists(f"{out}/file_summaries")
    assert plan.run(spark, df, out, file_model, commit_model) == {"processed": 0, "skipped": 3, "failed": 0}


def test_failed_file_does_not_fail_the_commit(spark, tmp_path):
    seen = str(tmp_path / "prompt")

    def answer_commit(prompt):
        with open(seen, "w") as f:
            f.write(prompt)
        return '{"semantic_summary": "ok"}'

    file_model = Model("bad", client=lambda: (lambda prompts: ["junk"] * len(prompts)))
    commit_model = logging_client(str(tmp_path / "log"), answer_commit)
    counts = plan.run(spark, files(spark, ("abc", 0, "--- a/one.py\n+1")), str(tmp_path / "o"), file_model, commit_model)
    assert counts == {"processed": 1, "skipped": 0, "failed": 0}
    assert f"- one.py: {FAILED_FILE}" in open(seen).read()


def test_summaries_that_do_not_shrink_fail_their_commit(spark):
    lines = spark.createDataFrame([("h", i, "x" * 30) for i in range(4)], "h string, i int, line string")
    messages = spark.createDataFrame([("h", "m")], "h string, commit_message string")
    endless = Model("long", reply=lambda p: F.lit('{"semantic_summary": "' + "y" * 50 + '"}'))
    row = synthesise(lines, messages, endless, ["h"], "i", "line", limit=40).first()
    assert row.status == "failed" and "too long" in row.error and row.levels == 1
    shrinking = Model("short", reply=lambda p: F.lit('{"semantic_summary": "s"}'))
    row = synthesise(lines, messages, shrinking, ["h"], "i", "line", limit=40).first()
    assert (row.value, row.levels) == ("s", 2)


def test_a_prompt_is_sent_three_times_at_most(spark, tmp_path):
    log = str(tmp_path / "log")

    def fail(prompt):
        raise RuntimeError("down")

    df = spark.createDataFrame([(str(i),) for i in range(5)], "p string").coalesce(1)

    def factory():
        def client(prompts):
            with open(log, "a") as f:
                f.writelines("sent\n" for _ in prompts)
            raise RuntimeError("down")

        return client

    assert infer(df, "p", "k", Model("bad", client=factory)).where("status = 'failed'").count() == 5
    assert calls(log) == 15


def test_forks_become_one_commit(spark, tmp_path):
    rows = files(spark, ("abc", 0, "--- a/one.py\n+1"), ("def", 0, "--- a/x.py\n+1"))
    fork = files(spark, ("abc", 0, "--- a/two.py\n+1")).withColumn("repo_id", F.lit("z/fork"))
    out = str(tmp_path / "out")
    done = plan.run(spark, rows.unionByName(fork), out, merge_forks=True)
    assert done == {"processed": 2, "skipped": 0, "failed": 0}
    stored = spark.read.parquet(f"{out}/summaries").orderBy("ord").collect()
    assert [(r.commit_hash, r.repo_id, r.ord) for r in stored] == [("abc", "o/r", 0), ("def", "o/r", 1)]


def test_forks_can_be_merged(spark):
    df = files(spark, ("abc", 0, "x")).unionByName(
        files(spark, ("abc", 0, "y")).withColumn("repo_id", F.lit("fork/r"))
    )
    assert commits_per_hash(df).count() == 2
    assert [r.n_files for r in commits_per_hash(df, merge_forks=True).collect()] == [2]
