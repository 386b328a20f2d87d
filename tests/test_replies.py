"""Recovery of values from damaged model replies."""

from pyspark.sql import functions as F

from gitloom.functions import prompts as pr
from gitloom.functions import replies as rp


def read(spark, reply, key="semantic_summary"):
    df = spark.createDataFrame([(reply,)], "v string")
    return df.select(rp.read_reply(F.col("v"), key).alias("r")).first().r


def test_read_reply(spark):
    cases = [
        ('{"semantic_summary": "Fixed"}', "Fixed", "json"),
        ('{"semantic_summary": "Fixed"', "Fixed", "repaired"),
        ('{"semantic_summary": "cut in the mid', "cut in the mid", "repaired"),
        ('```json\n{"semantic_summary": "M"}\n```', "M", "fenced"),
        ('```\n{"semantic_summary": "M"}\n```', "M", "fenced"),
        (r'{"semantic_summary": "a \"b\" c"}', 'a "b" c', "json"),
        (r'Sure: {"semantic_summary": "x\ny"', "x\ny", "regex"),
        ("{'semantic_summary': 'single'}", None, None),
        ('{"wrong_key": "v"}', None, None),
        ('{"semantic_summary": null}', None, None),
        ('{"semantic_summary": 5}', "5", "json"),
        ('[{"semantic_summary": "listed"}]', "listed", "regex"),
    ]
    df = spark.createDataFrame([(i, reply) for i, (reply, _, _) in enumerate(cases)], "i int, v string")
    got = df.select("i", rp.read_reply(F.col("v"), "semantic_summary").alias("r")).orderBy("i").collect()
    assert [(r.r.value, r.r.method) for r in got] == [(value, method) for _, value, method in cases]
    assert all((r.r.error is None) == (r.r.value is not None) for r in got)


def test_empty_reply_is_an_error(spark):
    assert read(spark, " \n").error == "empty reply"
    assert read(spark, None).error == "empty reply"


def test_error_shows_the_start_of_the_reply(spark):
    error = read(spark, "x" * 500).error
    assert error.endswith(": " + "x" * 200)


def test_very_long_value(spark):
    body = "word \\\" " * 60_000 + "end"
    got = read(spark, 'prefix {"semantic_summary": "' + body)
    assert got.method == "regex" and len(got.value) == len(body.replace("\\\"", '"'))


def test_render_does_not_touch_data(spark):
    df = spark.createDataFrame([("50% {diff}", "{file_path} %s")], "p string, d string")
    text = df.select(pr.file_prompt(F.col("p"), F.col("d"), True).alias("t")).first().t
    assert text == pr.FILE_SUMMARY.format(file_path="50% {diff}", diff="{file_path} %s") + "\n/no_think"


def test_typed_output(spark):
    df = spark.createDataFrame([('{"categories": ["a", "b"]}',), ('{"categories": 3',)], "v string")
    good, bad = [r.r for r in df.select(rp.read_typed(F.col("v"), "categories", "array<string>").alias("r")).collect()]
    assert good.value == ["a", "b"] and good.error is None
    assert bad.value is None and bad.error


def test_typed_output_in_fences_or_cut_short(spark):
    cases = {
        '```json\n{"categories": ["a", "b"]}\n```': ["a", "b"],
        '{"categories": ["a", "b"': ["a", "b"],
        '{"categories": ["a", "b"]': ["a", "b"],
        '{"categories": ["a", "b c': ["a", "b c"],
        '{"categories": ["a", ': ["a"],
        '```\n{"categories": ["a", "x \\" y': ["a", 'x " y'],
        "no list": None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    got = df.select("i", rp.read_typed(F.col("v"), "categories", "array<string>").alias("r")).orderBy("i").collect()
    assert [r.r.value for r in got] == list(cases.values())
