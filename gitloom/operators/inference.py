"""Batch model calls.

A model is either a column expression (the offline stub) or a client that maps a
list of prompts to a list of replies. Clients run in ``mapInPandas``; each attempt
is written to the shared folder before anything reads it, so a lost executor or a
re-evaluated plan does not call the model again for rows that are already stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.functions.replies import read_reply, read_typed
from gitloom.session import cut

Client = Callable[[list[str]], list[str]]

# --- fixed values ---
MAX_RETRIES = 3
BATCH_SIZE = 100
# --- end of fixed values ---


@dataclass(frozen=True)
class Model:
    """``reply`` (expression over the prompt) or ``client`` (factory, called per task)."""

    name: str
    reply: Callable[[Column], Column] | None = None
    client: Callable[[], Client] | None = None
    batch_size: int = BATCH_SIZE
    max_tasks: int | None = None


def stub_model(key: str, suffix: str = "") -> Model:
    """Offline stand-in: a JSON reply that names the prompt's digest and length."""

    def reply(prompt: Column) -> Column:
        text = F.concat(
            F.lit("stub "), F.md5(prompt), F.lit(" of "), F.length(prompt).cast("string"),
            F.lit(f" chars{suffix}"),
        )
        return F.concat(F.lit('{"' + key + '": "'), text, F.lit('"}'))

    return Model(name="stub", reply=reply)


def _call_batch(client: Client, prompts: list[str]) -> tuple[list[str | None], list[str | None]]:
    """Replies and errors of one call; a failed call is one failed attempt of all its prompts."""
    try:
        replies = list(client(prompts))
        if len(replies) == len(prompts):
            return replies, [None] * len(prompts)
        problem = f"{len(replies)} replies for {len(prompts)} prompts"
    except Exception as error:  # a failed call is a value, never a failed task
        problem = f"{type(error).__name__}: {error}"
    return [None] * len(prompts), [problem] * len(prompts)


def call_model(df: DataFrame, prompt_col: str, model: Model, singly: bool = False) -> DataFrame:
    """Add ``reply`` and ``call_error``; ``singly`` sends every prompt in a call of its own."""
    if model.reply is not None:
        return df.withColumn("reply", model.reply(F.col(prompt_col))).withColumn(
            "call_error", F.lit(None).cast("string")
        )
    factory, size = model.client, 1 if singly else model.batch_size
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("reply", T.StringType()),
            T.StructField("call_error", T.StringType()),
        ]
    )

    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for batch in batches:
            for start in range(0, len(batch), size):
                part = batch.iloc[start : start + size].copy()
                part["reply"], part["call_error"] = _call_batch(client, part[prompt_col].tolist())
                yield part

    source = df.repartition(model.max_tasks) if model.max_tasks else df
    return source.mapInPandas(infer, schema)


def infer(
    df: DataFrame,
    prompt_col: str,
    key: str,
    model: Model,
    max_retries: int = MAX_RETRIES,
    kind: str = "string",
) -> DataFrame:
    """Call the model until a value is read or ``max_retries`` attempts are used.

    The first of several attempts sends lists, the others single prompts, so one prompt
    that breaks a call costs the others of its list one attempt; a prompt is sent at most
    ``max_retries`` times.

    Adds ``value, method, status, attempts, error, model``. ``kind`` other than
    ``string`` reads structured output. Callers pass only the columns they need.
    """

    def read(called: DataFrame) -> DataFrame:
        if kind == "string":
            parsed = read_reply(F.col("reply"), key)
            method = F.col("__parsed.method")
        else:
            parsed = read_typed(F.col("reply"), key, kind)
            method = F.lit("json")
        return (
            called.withColumn("__parsed", parsed)
            .withColumn("value", F.col("__parsed.value"))
            .withColumn("method", F.when(F.col("value").isNotNull(), method))
            .withColumn("status", F.when(F.col("value").isNull(), "failed").otherwise("completed"))
            .withColumn("error", F.coalesce("call_error", "__parsed.error"))
            .withColumn("model", F.lit(model.name))
            .drop("__parsed", "call_error")
        )

    failed = F.col("status") == "failed"
    if model.reply is not None:
        # An expression gives the same reply each time: no need to ask again.
        return read(call_model(df, prompt_col, model)).withColumn(
            "attempts", F.when(failed, max_retries).otherwise(1)
        )
    columns = df.columns
    pending, done = df, None
    for attempt in range(1, max_retries + 1):
        last = attempt == max_retries
        called = call_model(pending, prompt_col, model, singly=attempt > 1 or last)
        tried = cut(read(called).withColumn("attempts", F.lit(attempt)), "attempt")
        kept = tried if last else tried.where(~failed)
        done = kept if done is None else done.unionByName(kept)
        pending = tried.where(failed).select(*columns)
        if not last and pending.isEmpty():
            break
    return done
