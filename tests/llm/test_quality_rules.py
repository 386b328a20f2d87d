import random

from gitloom.llm import quality_rules
from tests.llm import brute


def _texts():
    rng = random.Random(2)
    pool = ["the", "of", "and", "alpha", "beta", "gamma!!", "délta", "x|y", "#", "%%", "Wörd", "🙂"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 90))) for _ in range(60)]
    texts += ["\n".join(rng.choices(texts[:4] + ["", " \t"], k=6)) for _ in range(20)]
    base = " ".join(f"w{i}" for i in range(40))
    texts += [base, base + "\n" + base, base + " " + " ".join(f"w{i}" for i in range(5, 19))]
    texts += ["one two three four five six seven eight " * 2, "a b c d e f g h", "for " * 500]
    texts += [None, "", " \n\t ", "single", " ".join(f"v{i % 9000}" for i in range(20_000))]
    return texts


def test_measures_equal_brute_force(spark):
    texts = _texts()
    rows = [(i, t, i, "q") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, QUALITY string")
    for r in quality_rules.judge(docs).collect():
        expected = brute.quality(r["text"])
        assert {k: r["quality"][k] for k in expected} == expected, r["text"]
        n, repeat = expected["n_words"], expected["n_repeat_words"]
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
        assert r["n_words"] == r["doc_id"]


def test_each_rule_decides(spark):
    plain = "the house of words and more that is for it as was with be by on not are this from".split()
    texts = {
        "symbols": " ".join(w + "#" for w in plain * 3),
        "marks": " ".join(w + "!!" for w in plain * 3),
        "stop_words": " ".join(f"word{i}" for i in range(80)),
        "long_words": " ".join(w + "x" * 30 + str(i) for i, w in enumerate(plain)),
        "short_words": " ".join("abcdefghijklmnopqrstuvwxyz"),
        "duplicate_lines": "\n".join(["a the"] * 9 + [" ".join(plain * 1)]),
        "": " ".join(plain),
    }
    docs = spark.createDataFrame(list(texts.items()), "want string, text string")
    for r in quality_rules.judge(docs).collect():
        assert (r["want"] in r["failed_rules"]) if r["want"] else r["kept"], r


def test_a_filter_on_the_verdict_does_not_repeat_the_steps(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules.judge(docs).where("kept").select("text")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2


def test_plan_has_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert quality_rules.judge(docs.limit(0)).count() == 0
