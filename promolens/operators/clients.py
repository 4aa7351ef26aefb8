"""Model clients: anything that answers a prompt with a text. A job takes a factory; each task builds one client and keeps it.

No client reaches the network here. ``KeywordClient`` answers by the category hints, so that jobs and tests are repeatable.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.functions import vocab

Client = Callable[[str], str]


class KeywordClient:
    """Answers with the first sentence of the prompt's text that holds a hint, and the longest hint's category; with No Incentive if none does."""

    def __init__(self, talk: str = "Answer: "):
        self.talk = talk  # what it says before the JSON
        self.hints = sorted(vocab.HINTS.items(), key=lambda x: -len(x[0]))

    def __call__(self, prompt: str) -> str:
        text = prompt.partition("Text:\n")[2] or prompt
        for key, category in self.hints:
            at = text.lower().find(key)
            if at >= 0:
                begin = max(text.rfind(c, 0, at) for c in ".!?\n") + 1
                teaser = " ".join(text[begin : at + len(key) + 60].split()[:10])
                return self.talk + json.dumps({"category": category, "teaser": teaser, "timing": "Unknown", "value": "Unknown"})
        return json.dumps({"category": "No Incentive"})


def _asker(factory: Callable[[], Client], prompt: str, retries: int):
    """Adds answer, error and tries to frames. A call that raises is made again; what it raised last is the error of a prompt without an answer."""

    def one(client, p) -> tuple[str | None, str | None, int]:
        if p is None or p != p:
            return None, None, 0
        error = None
        for k in range(1, retries + 2):
            try:
                if (said := client(p)) is not None:
                    return str(said), None, k
                error = "no answer"
            except Exception as e:  # told in the error column
                error = f"{type(e).__name__}: {e}"
        return None, error, retries + 1

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in frames:
            got = [one(client, p) for p in pdf[prompt]]
            yield pdf.assign(__answer=[x[0] for x in got], __error=[x[1] for x in got], __tries=[x[2] for x in got])

    return work


def _asked(df: DataFrame, prompt: str, factory: Callable[[], Client], retries: int) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", __answer string, __error string, __tries int"
    return df.mapInPandas(_asker(factory, prompt, retries), schema)


STORE = "key string, answer string, error string, tries int, at timestamp"


def answers(spark: SparkSession, store: str) -> DataFrame:
    """(key, answer, error, tries) of a store: for each prompt its latest answer, or its latest failure if it never had one. An empty table if there is no store."""
    try:
        kept = spark.read.schema(STORE).parquet(store)
    except AnalysisException:
        kept = spark.createDataFrame([], STORE)
    best = F.max_by(F.struct("answer", "error", "tries"), F.struct(F.col("answer").isNotNull(), "at"))
    return kept.groupBy("key").agg(best.alias("x")).select("key", "x.answer", "x.error", "x.tries")


def answered(df: DataFrame, prompt: str, name: str, factory: Callable[[], Client], store: str | None = None, retries: int = 2) -> DataFrame:
    """df with the client's answer to each prompt (``name``) and why there is none (``name``_error); rows without a prompt are not sent and have neither.

    store: a Parquet folder in which answers are kept by the SHA-256 of their prompt. Equal prompts are sent once; those that it has an answer to
    are not sent again; new answers and failures are written there before anything uses them (so this function runs a job), and failed prompts are
    sent again by the next run alone. A task that is lost repeats its own prompts, none of which is in the store yet."""
    error = f"{name}_error"
    if store is None:
        d = _asked(df, prompt, factory, retries)
        return d.select(*df.columns, F.col("__answer").alias(name), F.col("__error").alias(error))
    spark, key = df.sparkSession, F.sha2(F.col(prompt).cast("binary"), 256)
    asked = df.where(F.col(prompt).isNotNull()).select(key.alias("key"), F.col(prompt).alias("prompt")).groupBy("key").agg(F.min("prompt").alias("prompt"))
    new = asked.join(answers(spark, store).where("answer IS NOT NULL").select("key"), "key", "left_anti")
    got = _asked(new, "prompt", factory, retries)
    got.select("key", F.col("__answer").alias("answer"), F.col("__error").alias("error"), F.col("__tries").alias("tries"), F.current_timestamp().alias("at")).write.mode("append").parquet(store)
    told = answers(spark, store).select(F.col("key").alias("__key"), F.col("answer").alias(name), F.col("error").alias(error))
    return df.join(told, key == F.col("__key"), "left").select(*df.columns, name, error)
