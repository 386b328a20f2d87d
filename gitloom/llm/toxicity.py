"""Toxicity as gradient-boosted trees over a few dense features, with isotonic calibration.

Features are rates of a text: words of a lexicon, such words near a second-person pronoun,
capitals, punctuation and obfuscated words. The lexicon is a given list plus word stems
that training rows show to be typical of toxic texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, with_columns, without
from gitloom.llm.labelled import training_sample
from gitloom.session import cut

#: Labelled rows that are used at most (about) for the trees, and for the stems.
MAX_TRAINING_ROWS = 20_000
MAX_STEM_ROWS = 6_000
#: Stems that are kept at most; how much likelier they are in toxic texts; their length.
MAX_STEMS = 400
MIN_RATIO = 8.0
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
#: Words between a lexicon word and a pronoun that still count as near.
NEAR = 4

# --- fixed values ---
LEXICON = (
    "asshole bastard bitch clown coward creep crap cretin disgusting dumb dumbass fool freak "
    "garbage idiot idiotic imbecile jerk liar loser lowlife moron moronic numbskull pathetic pig "
    "psycho scum scumbag shit shut sleazy stupid trash twit ugly vermin vile worthless wretch "
    "abruti arschloch basura cabron connard dreck dumm dummkopf estupido idiota idioten imbecil "
    "merde mierda miststueck ordure pendejo salaud scheisse tonto trottel"
)
PRONOUNS = (
    "you your yours yourself u ur youre du dich dir dein deine deiner ihr euch euer tu te toi ton ta "
    "tes vous votre vos usted ustedes ti tus vosotros"
)
LEET = "0o1i3e4a5s7t@a$s!i"
# --- end of fixed values ---

_LEXICON, _PRONOUNS = frozenset(LEXICON.split()), frozenset(PRONOUNS.split())
_PLAIN = str.maketrans(LEET[::2], LEET[1::2])
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_SIGNS = re.compile(r"[^\w\s]")
_INNER = re.compile(r"[^\W\d_][^\w\s]+[^\W\d_]|[^\W\d_][0-9@$!]+[^\W\d_]")

FEATURES = (
    "lexicon_rate", "lexicon_count", "stem_rate", "stem_count", "stem_share", "near_rate",
    "capital_rate", "exclamation_rate", "punctuation_rate", "obfuscated_rate", "hidden_rate",
    "log_words",
)


def stems_of(word: str) -> Iterable[str]:
    """The word itself (marked) and its beginnings."""
    yield word + "$"
    for n in STEM_LENGTHS:
        if len(word) >= n:
            yield word[:n]


def features(text: str, stems: frozenset[str]) -> list[float]:
    """The values named by FEATURES; an empty text has zeros."""
    raw = text.split()
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    cores = [w.strip(_EDGES).lower() for w in raw]
    hits, stem_hits, hidden, obfuscated, capitals = [], 0, 0, 0, 0
    for i, core in enumerate(cores):
        if core in _LEXICON:
            hits.append(i)
        if stems and any(s in stems for s in stems_of(core)):
            stem_hits += 1
        if not core.isalpha() and len(core) > 2 and _INNER.search(core):
            obfuscated += 1
            plain = _SIGNS.sub("", core.translate(_PLAIN))
            if plain in _LEXICON or _SIGNS.sub("", core) in _LEXICON:
                hidden += 1
                hits.append(i)
        if len(core) > 1 and raw[i].isupper():
            capitals += 1
    near = sum(1 for i in hits if not _PRONOUNS.isdisjoint(cores[max(0, i - NEAR) : i + NEAR + 1]))
    signs = len(_SIGNS.findall(text))
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        stem_hits / n,
        math.log1p(stem_hits),
        min(1.0, stem_hits / math.sqrt(n)),
        near / n,
        capitals / n,
        text.count("!") / n,
        signs / n,
        obfuscated / n,
        hidden / n,
        math.log1p(n),
    ]


@dataclass
class ToxicityModel:
    stems: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float


def learn_stems(rows: DataFrame) -> frozenset[str]:
    """Words and word beginnings that are typical of toxic rows; at most MAX_STEMS.

    Counted over ``text, label`` as documents that have the stem, each once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            stems, labels = [], []
            texts, marks = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            for text, label in zip(texts, marks, strict=True):
                words = {w.strip(_EDGES).lower() for w in (text or "").split()}
                found = {s for w in words if len(w) > 2 for s in stems_of(w)}
                stems += found
                labels += [label] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(stems, pa.string()), pa.array(labels, pa.int32())], names=["stem", "label"]
            )

    toxic, total = rows.agg(F.sum("label"), F.count("*")).first()
    if not toxic or toxic == total:
        return frozenset()
    counts = (
        rows.select("text", "label")
        .mapInArrow(run, "stem string, label int")
        .groupBy("stem")
        .agg(F.sum("label").alias("bad"), F.count("*").alias("every"))
    )
    ratio = (F.col("bad") / toxic) / ((F.col("every") - F.col("bad") + 0.5) / (total - toxic))
    typical = counts.where((F.col("bad") >= max(4, toxic // 100)) & (ratio >= MIN_RATIO))
    best = typical.orderBy(F.desc("bad"), F.desc(ratio), "stem").limit(MAX_STEMS)
    return frozenset(r["stem"] for r in best.collect())


def with_features(docs: DataFrame, stems: frozenset[str], text: str, out: str) -> DataFrame:
    source = without(docs, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            found = [features(t or "", stems) for t in batch.column(text).to_pylist()]
            yield with_columns(batch, **{out: pa.array(found, pa.list_(pa.float64()))})

    return source.mapInArrow(run, extended(source.schema, **{out: T.ArrayType(T.DoubleType())}))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS
) -> ToxicityModel:
    """Trees on four fifths of the labelled sample, calibration on the rest.

    Where the rows for the trees lack a class (or there are none), every score is the share
    of toxic rows in the sample, 0 without rows. Where those for the calibration lack one,
    the trees' chances are the scores.
    """
    sample = cut(training_sample(docs, labels, label, max_rows), "toxic-sample")
    part = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5 * 1_000_003))
    grows = F.when(part % 5 != 0, F.col("label"))
    total, rate, least, most = sample.agg(F.count("*"), F.avg("label"), F.min(grows), F.max(grows)).first()
    if least == most:  # one class, or null where there is no row
        return ToxicityModel(frozenset(), None, None, rate or 0.0)
    first = sample.where(part % 5 != 0)
    share = min(1.0, MAX_STEM_ROWS / total)
    stems = learn_stems(first.where(part < share * 5 * 1_000_003))
    rows = cut(
        with_features(sample, stems, "text", "__values")
        .withColumn("calibrate", part % 5 == 0)
        .select("label", "calibrate", "__values"),
        "toxic-features",
    )
    # The sample is bounded: a few partitions keep the many small jobs of the trees short.
    ready = rows.coalesce(4).select(
        F.col("label").cast("double").alias("label"),
        "calibrate",
        array_to_vector("__values").alias("__features"),
    )
    # Columns of its own for all that the models add: a document may have any other.
    trees = GBTClassifier(
        featuresCol="__features", predictionCol="__class", maxIter=20, maxDepth=3, stepSize=0.3,
        minInstancesPerNode=5, seed=7,
    )
    trees = trees.setRawPredictionCol("__raw").setProbabilityCol("__probability")
    grown = trees.fit(ready.where("not calibrate"))
    held = grown.transform(ready.where("calibrate"))
    held = held.select("label", vector_to_array("__probability")[1].alias("__chance"))
    spread = held.agg(F.countDistinct("label")).first()[0]
    isotonic = IsotonicRegression(featuresCol="__chance", predictionCol="__calibrated")
    fitted = isotonic.fit(held) if spread == 2 else None
    return ToxicityModel(stems, grown, fitted, rate)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out`` in 0 to 1. Null and empty texts have zero features; other columns and
    repeated rows pass, a column named ``out`` is replaced."""
    source = without(docs, out)
    if model.trees is None:
        return source.withColumn(out, F.lit(float(model.rate)))
    found = with_features(source, model.stems, text, "__values")
    scored = model.trees.transform(found.withColumn("__features", array_to_vector("__values")))
    chance = scored.withColumn("__chance", vector_to_array("__probability")[1])
    if model.calibration is None:
        value = F.col("__chance")
    else:
        chance, value = model.calibration.transform(chance), F.col("__calibrated")
    return chance.select(*[f"`{c}`" for c in source.columns], value.alias(out))
