import random

from gitloom.llm import decontamination
from tests.llm import brute


def _case():
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(30)] + ["é1", "Straße", "x_y", "don't"]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "?!"), (None, "lonely words of nobody"), (3, "again three words")]
    items += [(200, items[7][1])]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(60)]
    for _, body in items:
        around = " ".join(rng.choices(pool, k=12))
        texts.append(f"{around}... {(body or '').upper()}!!{around}")
    texts += [None, "", "...", "W1" * 3, " ".join(pool * 3000)]
    return items, texts


def test_equals_brute_force(spark):
    items, texts = _case()
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ITEMS string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 60):  # one automaton, and many passes
        found = decontamination.mark_contamination(docs, benchmark, automaton_bytes=limit)
        for r in found.collect():
            expected = brute.contamination(r["text"], items)
            assert (r["n_words"], r["n_hit"], r["items"]) == expected, r
            assert r["contaminated"] == (r["n_hit"] > 0)
            spans = [r["text"][s["start"] : s["end"]] for s in r["spans"]]
            assert sum(len(brute.benchmark_words(s)) for s in spans) == r["n_hit"]
    assert decontamination.mark_contamination(docs.limit(0), benchmark).count() == 0
    clean = decontamination.mark_contamination(docs, benchmark.limit(0))
    assert clean.where("contaminated or n_hit > 0 or size(items) > 0").isEmpty()
    assert clean.agg({"n_words": "sum"}).first()[0] == sum(len(brute.benchmark_words(t)) for t in texts)


def test_spans_of_many_hits_in_a_long_text():
    text = "é a ü, " * 50_000
    ranges = [(3 * i, 3 * i + 1) for i in range(50_000)]
    spans = decontamination.original_spans(text.encode(), ranges)
    assert [text[s["start"] : s["end"]] for s in spans] == ["é"] * 50_000
    assert [s["start"] for s in spans] == list(range(0, 7 * 50_000, 7))
    assert decontamination.original_spans(b"", []) == []
