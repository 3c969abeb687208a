"""Sound in and out, and judges, as injected functions: decoders, speakers, text and audio judges.

Sound is a row's binary column or an array of samples. Whatever calls a model or a codec is a function that the caller
gives; what is built in reads and writes PCM sound files with the standard library.
"""

from __future__ import annotations

import io
import re
import time
import wave
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lenient import json_object
from ..functions.text import RECOVERABLE, RETRYABLE, data_uri, mime_type
from .models import SPEECH, Retry, apply_model

#: One try, whatever the error: how the judges of texts and sounds are called.
ONCE = Retry(attempts=1)


def pcm_decoder(rate: int | None = None):
    """A factory of a decoder of PCM files: (interleaved samples from -1 to 1, channels, rate)."""

    def factory():
        import numpy as np

        def decode(data: bytes):
            with wave.open(io.BytesIO(data)) as file:
                width, channels, own = file.getsampwidth(), file.getnchannels(), file.getframerate()
                raw = file.readframes(file.getnframes())
            if rate is not None and own != rate:
                raise ValueError(f"the file has {own} samples a second, not {rate}")
            if width == 1:
                return (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128, channels, own
            return np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1)), channels, own

        return decode

    return factory


def decode_audio(
    files: DataFrame, factory: Callable[[], Callable], content: str = "content", fallback: Callable[[], Callable] | None = None, mono: bool = True
) -> DataFrame:
    """The rows with ``wave``, ``rate`` and ``error``. ``wave`` is the mean of the channels, or an array for each of them.

    ``fallback`` decodes what the first decoder fails on. A file without samples is an error; a null one, too.
    """
    samples = T.ArrayType(T.FloatType())
    fields = [T.StructField("wave", samples if mono else T.ArrayType(samples)), T.StructField("rate", T.IntegerType())]

    def both():
        decoders = [factory(), *([fallback()] if fallback else [])]

        def decode(rows):
            out = []
            for (data,) in rows:
                for k, one in enumerate(decoders):
                    try:
                        flat, channels, rate = one(bytes(data))
                        break
                    except Exception:  # noqa: BLE001  the next decoder may read it
                        if k + 1 == len(decoders):
                            raise
                if not len(flat):
                    raise ValueError("decoding gave no samples")
                split = flat.reshape(-1, channels).T
                out.append({"wave": split.mean(axis=0).tolist() if mono else [c.tolist() for c in split], "rate": int(rate)})
            return out

        return decode

    done = apply_model(files, both, [content], T.StructField("_decoded", T.StructType(fields)), ONCE)
    kept = [c for c in done.columns if c not in ("wave", "rate", "_decoded", "attempts", "duration_ms", "error")]
    return done.select(*kept, "_decoded.wave", "_decoded.rate", "error")


def pcm_file(samples: Iterable[float], rate: int, channels: int = 1) -> bytes:
    """A 16-bit PCM file of interleaved samples, clipped to -1 and 1."""
    import numpy as np

    flat = np.clip(np.asarray(list(samples), np.float64), -1, 1)
    out = io.BytesIO()
    with wave.open(out, "wb") as file:
        file.setnchannels(channels)
        file.setsampwidth(2)
        file.setframerate(rate)
        file.writeframes(np.rint(flat * 32767).astype("<i2").tobytes())
    return out.getvalue()


def silence(seconds: float = 0.3, rate: int = 16_000) -> bytes:
    return pcm_file([0.0] * int(rate * seconds), rate)


def to_pcm(waves: DataFrame, rate: int = 16_000, samples: str = "wave") -> DataFrame:
    """The rows with ``wav``, a mono 16-bit file of their samples; null for null."""

    def factory():
        return lambda rows: [None if x is None else pcm_file(x, rate) for (x,) in rows]

    return apply_model(waves, factory, [samples], T.StructField("wav", T.BinaryType()), ONCE).drop("error", "attempts", "duration_ms")


@dataclass(frozen=True)
class Voice:
    """Whose voice speaks: a reference sound with its text (kept by the model if ``cached``), a known speaker, or silence."""

    reference: str | None = None
    reference_text: str = ""
    speaker: str | None = None
    cached: bool = False
    mock: bool = False


def speak(turns: DataFrame, factory: Callable[[], Callable], voice: Voice, retry: Retry = SPEECH) -> DataFrame:
    """Turns of a speech plan with ``wav`` and ``tts_error``; those without ``tts_text`` stay as they are.

    The synthesiser gets ``(text, mode, **arguments)`` with mode ``clone``, ``cached`` or ``speaker`` and yields pieces of
    samples, with its ``rate`` as an attribute; the pieces of a turn become one file. No piece at all is an error.
    """

    def both():
        model = None if voice.mock else factory()

        def one(text: str) -> bytes:
            if voice.mock:
                return silence()
            if voice.reference:
                if not voice.reference_text.strip():
                    raise RuntimeError("a reference sound needs its text")
                given = ("cached", {}) if voice.cached else ("clone", {"reference": voice.reference, "reference_text": voice.reference_text.strip()})
            elif voice.speaker:
                given = ("speaker", {"speaker": voice.speaker})
            else:
                raise RuntimeError("no voice: neither a reference sound nor a speaker")
            pieces = [x for piece in model(text, given[0], **given[1]) for x in piece]
            if not pieces:
                raise RuntimeError("the synthesiser returned no sound")
            return pcm_file(pieces, getattr(model, "rate", 24_000))

        return lambda rows: [None if text is None else one(text) for (text,) in rows]

    done = apply_model(turns, both, ["tts_text"], T.StructField("wav", T.BinaryType()), retry, batch=1)
    out = done.withColumn("tts_error", F.coalesce("error", "tts_error")).withColumn("tts_audio", F.when(F.col("error").isNull(), F.col("tts_audio")))
    return out.select(*turns.columns, "wav")


def judge_texts(rows: DataFrame, factory: Callable[[], Callable], prompt: str = "prompt", system: str | None = None, retry: Retry = ONCE) -> DataFrame:
    """The rows with ``verdict_text`` and ``api_error``. The judge gets (system or None, prompt)."""

    def each():
        judge = factory()
        return lambda prompts: [judge(system, p) for (p,) in prompts]

    done = apply_model(rows, each, [prompt], T.StructField("verdict_text", T.StringType()), retry, batch=1)
    return done.withColumnRenamed("error", "api_error").drop("attempts", "duration_ms")


def folded(system: str, prompt: str) -> str:
    """A prompt that holds its own system text, for services without a field for it. The two headings."""
    return f"System:\n{system}\n\nUser:\n{prompt}"


def with_system(judge: Callable, system: str, prompt: str, *rest):
    """The judge's answer; where it rejects the system field, its answer to a prompt that holds the system text."""
    try:
        return judge(system, prompt, *rest)
    except Exception as error:  # noqa: BLE001  whatever a client raises
        if not re.search(RECOVERABLE, str(error).lower()):
            raise
        return judge(None, folded(system, prompt), *rest)


def judge_sounds(
    rows: DataFrame, factory: Callable[[], Callable], system: str, prompt: str = "prompt", content: str = "content", path: str = "tts_audio"
) -> DataFrame:
    """The rows with ``verdict_text`` and ``api_error``. The judge gets (system or None, prompt, data URI of the sound)."""

    def each():
        judge = factory()
        return lambda some: [None if uri is None else with_system(judge, system, p, uri) for p, uri in some]

    linked = rows.withColumn("_uri", data_uri(F.col(content), mime_type(F.col(path), "judge")))
    done = apply_model(linked, each, [prompt, "_uri"], T.StructField("verdict_text", T.StringType()), ONCE, batch=1)
    return done.withColumnRenamed("error", "api_error").drop("attempts", "duration_ms", "_uri")


def generate_object(function: Callable, system: str, prompt: str, retry: Retry = Retry(), sleep=time.sleep) -> str:
    """The JSON object of a text model's answer, as text. Each attempt tries the system field, then goes without it."""
    pauses = retry.pauses()

    def ask() -> str:
        text = (with_system(checked, system, prompt) or "").strip()
        found, problem = json_object(text)
        if problem:
            raise ValueError(problem)
        return found

    def checked(*given):
        text = function(*given)
        if not (text or "").strip():
            raise ValueError("empty model text")
        return text

    for attempt in range(retry.attempts):
        try:
            return ask()
        except Exception as error:  # noqa: BLE001
            if attempt == len(pauses) or not re.search(RETRYABLE, str(error).lower()):
                raise
            sleep(pauses[attempt])
    raise RuntimeError("no attempt was made")


def generate_objects(
    rows: DataFrame, factory: Callable[[], Callable], system: str, prompt: str = "prompt", retry: Retry = Retry()
) -> DataFrame:
    """The rows with ``object`` (JSON text) and ``error``; a row's failure is its own."""

    def each():
        model = factory()
        return lambda some: [generate_object(model, system, p, retry) for (p,) in some]

    done = apply_model(rows, each, [prompt], T.StructField("object", T.StringType()), ONCE, batch=1)
    return done.drop("attempts", "duration_ms")


def channels_of(interleaved: Column, n: int) -> Column:
    """Interleaved samples as an array for each channel."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda c: F.filter(interleaved, lambda x, i: i % n == c))
