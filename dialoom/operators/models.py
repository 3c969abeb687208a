"""Model calls as injected functions: batches in workers, retries, fallbacks and a log row next to each result.

Nothing here calls out by itself. A function gets plain values and returns plain values; it is loaded once a worker by
its factory, so that heavy models are built where they run.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import RETRYABLE


@dataclass(frozen=True)
class Retry:
    """Attempts, first pause, factor and longest pause; ``only_transient`` gives up on other errors at once."""

    attempts: int = 5
    pause: float = 2.0
    factor: float = 2.0
    longest: float = 60.0
    only_transient: bool = True

    def pauses(self) -> list[float]:
        return [min(self.longest, self.pause * self.factor**k) for k in range(self.attempts - 1)]


#: The speech synthesiser tries three times, whatever the error, and doubles its pause.
SPEECH = Retry(attempts=3, pause=1.0, longest=float("inf"), only_transient=False)
_PLAINER = re.compile("400|unknown|invalid|field")


def call(function: Callable, *args, retry: Retry = Retry(), plainer: Callable | None = None, sleep=time.sleep):
    """(result, error, attempts). ``plainer`` replaces the function after a first error that says the form was wrong."""
    pauses, error = retry.pauses(), None
    for attempt in range(1, retry.attempts + 1):
        try:
            return function(*args), None, attempt
        except Exception as found:  # noqa: BLE001  whatever a model's client raises
            error = f"{type(found).__name__}: {found}"
            message = str(found).lower()
            if attempt == 1 and plainer is not None and _PLAINER.search(message):
                function = plainer
                continue
            if attempt > len(pauses) or (retry.only_transient and not re.search(RETRYABLE, message)):
                return None, error, attempt
            sleep(pauses[attempt - 1])
    return None, error, retry.attempts


def _counted(function: Callable) -> Callable:
    """The function, which fails where it does not return an output for each row."""

    def run(rows):
        made = list(function(rows))
        if len(made) != len(rows):
            raise ValueError(f"{len(made)} outputs for {len(rows)} rows")
        return made

    return run


def apply_model(
    df: DataFrame, factory: Callable[[], Callable], inputs: list[str], output: T.StructField, retry: Retry = Retry(), batch: int = 64,
    plainer: Callable[[], Callable] | None = None,
) -> DataFrame:
    """The rows with the model's output, ``error``, ``attempts`` and ``duration_ms``.

    The model gets a list of input tuples of at most ``batch`` rows and returns a list of as many outputs. A batch that
    fails is given again row by row, so an error is that of its own row. ``plainer`` makes the model that takes over after
    a first error about the request's form. Repartition first to bound how many calls run at once.
    """
    kept = [f for f in df.schema if f.name not in (output.name, "error", "attempts", "duration_ms")]
    schema = T.StructType(
        [*kept, output, T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("duration_ms", T.DoubleType())]
    )

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        model, plain = _counted(factory()), _counted(plainer()) if plainer else None

        def answers(rows):
            """(output, error, attempts, milliseconds) of each row."""
            began = time.perf_counter()
            made, error, attempts = call(model, rows, retry=retry if len(rows) == 1 else Retry(attempts=1), plainer=plain if len(rows) == 1 else None)
            if error and len(rows) > 1:
                return [x for row in rows for x in answers([row])]
            spent = (time.perf_counter() - began) * 1000 / max(len(rows), 1)
            return [(x, error, attempts, spent) for x in ([None] * len(rows) if error else made)]

        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                rows = list(zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs)))
                made, errors, attempts, spent = zip(*answers(rows))
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                columns += [pa.array(made, to_arrow_type(output.dataType)), pa.array(errors, pa.string())]
                columns += [pa.array(attempts, pa.int32()), pa.array(spent, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)


def converse(df: DataFrame, factory: Callable[[], Callable[[str, str], str]], history: Callable[[list[str], list[str]], str], retry: Retry = Retry(),
             plainer: Callable[[], Callable[[str, str], str]] | None = None) -> DataFrame:
    """Replies to every turn of a dialog, one after the other, stopping at the first error.

    ``df`` has ``manifest_line``, ``transcripts``, ``next_turn`` and ``prior`` (replies so far). The model gets the
    history and the turn's transcript; dialogs run side by side, turns of one do not.
    """
    turn = "struct<turn_index:int,query:string,plain_text:string,error:string>"

    def run(batches):
        import pyarrow as pa

        model, plain = factory(), plainer() if plainer else None
        kind = pa.list_(pa.struct([("turn_index", pa.int32()), ("query", pa.string()), ("plain_text", pa.string()), ("error", pa.string())]))
        for batch in batches:
            out, calls = [], []
            for line in batch.to_pylist():
                said, turns, n = list(line["prior"] or []), [], 0
                for k in range(line["next_turn"] or len(line["transcripts"]) + 1, len(line["transcripts"]) + 1):
                    query = line["transcripts"][k - 1]
                    reply, error, tries = call(model, history(line["transcripts"][:k], said), query, retry=retry, plainer=plain)
                    n += tries
                    turns.append({"turn_index": k, "query": query, "plain_text": reply, "error": error})
                    if error:
                        break
                    said.append(reply)
                out.append(turns)
                calls.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind), pa.array(calls, pa.int32())], ["manifest_line", "new_turns", "n_api"])

    kept = df.select(F.col("manifest_line").cast("long").alias("manifest_line"), "transcripts", "next_turn", "prior")
    return kept.mapInArrow(run, f"manifest_line long, new_turns array<{turn}>, n_api int")


def call_log(results: DataFrame, model: str, user: str, request: str, response: str) -> DataFrame:
    """Log rows of model results: a projection of what ``apply_model`` adds, without a lock."""
    size = lambda c: F.coalesce(F.length(F.col(c)), F.lit(0)).cast("long")
    return results.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit(model).alias("model"), F.lit(user).alias("user"),
        F.col(request).alias("request"), F.col(response).alias("response"), size(request).alias("prompt_chars"), size(response).alias("completion_chars"),
        *[F.lit(0).cast("long").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")],
        "duration_ms", F.col("error").isNull().alias("success"), "error", F.lit(None).cast("string").alias("metadata"),
    )


def echo_model():
    """A deterministic stand-in for a reply model."""
    return lambda history, query: f"reply to {len(query)} characters"


def hash_embedder(width: int = 8):
    """A factory of a deterministic stand-in for a sentence embedder: unit vectors from a hash of the text."""

    def factory():
        import hashlib
        import math

        def embed(rows):
            out = []
            for (text,) in rows:
                digest = hashlib.sha256((text or "").encode()).digest()
                v = [b - 127.5 for b in digest[:width]]
                norm = math.sqrt(sum(x * x for x in v))
                out.append([x / norm for x in v])
            return out

        return embed

    return factory


def audio_frontend(df: DataFrame, *stages: Callable[[], Callable], retry: Retry = Retry()) -> DataFrame:
    """Waves through separation, enhancement or any other stage that maps waves to waves."""
    wave = T.StructField("wave", T.ArrayType(T.FloatType()))
    for factory in stages:
        df = apply_model(df, factory, ["wave"], wave, retry).drop("error", "attempts", "duration_ms")
    return df


def transcribe(clips: DataFrame, factory: Callable[[], Callable], retry: Retry = Retry()) -> DataFrame:
    """Label rows with ``content`` from their clips; a clip without samples reads as empty text."""
    done = apply_model(clips, factory, ["wave"], T.StructField("content", T.StringType()), retry)
    return done.withColumn("content", F.when(F.size("wave") > 0, F.col("content")).otherwise(F.lit("")))


def child_scores(clips: DataFrame, factory: Callable[[], Callable], retry: Retry = Retry()) -> DataFrame:
    """``p_child`` of each clip, clamped to 0 and 1."""
    done = apply_model(clips, factory, ["wave"], T.StructField("p_child", T.DoubleType()), retry)
    return done.withColumn("p_child", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("p_child"))))
