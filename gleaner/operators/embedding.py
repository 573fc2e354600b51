"""Embedding and generation through caller-supplied functions over batches."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashed import hashed_counts

EmbedFactory = Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]
GenerateFactory = Callable[[], Callable[[Sequence[str]], Sequence[str]]]

_embedders: dict[str, Callable[[DataFrame, str], DataFrame]] = {}


def register_embedder(name: str, factory: EmbedFactory, batch_rows: int = 64) -> None:
    """Name an embedding function; the factory runs once per task and makes its client."""
    _embedders[name] = lambda df, text: embed_batch(df, text, factory, batch_rows)


def hashed_embedder(width: int) -> Callable[[DataFrame, str], DataFrame]:
    return lambda df, text: df.withColumn("vector", hashed_counts(F.col(text), width))


def embed(df: DataFrame, text: str, model: str) -> DataFrame:
    """Add ``vector`` and ``model``. ``hash-<width>`` is the built-in embedder.

    Corpus and questions must go through the same name.
    """
    if model in _embedders:
        out = _embedders[model](df, text)
    elif model.startswith("hash-") and model[5:].isdigit():
        out = hashed_embedder(int(model[5:]))(df, text)
    else:
        raise ValueError(f"Unsupported embedding model: {model}")
    return out.withColumn("model", F.lit(model))


def _chunks(pdf: pd.DataFrame, n: int) -> Iterator[pd.DataFrame]:
    for at in range(0, len(pdf), n):
        yield pdf.iloc[at : at + n]


def embed_batch(df: DataFrame, text: str, factory: EmbedFactory, batch_rows: int = 64) -> DataFrame:
    """Add ``vector ARRAY<FLOAT>`` computed by a caller's function on text batches."""
    from pyspark.sql.types import ArrayType, FloatType, StructType

    schema = StructType([*df.schema.fields]).add("vector", ArrayType(FloatType()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = factory()
        for pdf in frames:
            for part in _chunks(pdf, batch_rows):
                yield part.assign(vector=[list(map(float, v)) for v in call(part[text].tolist())])

    return df.mapInPandas(run, schema)


def _timed(call: Callable, timeout: float | None) -> Callable:
    """``call`` that gives up waiting after ``timeout`` seconds."""
    if timeout is None:
        return call

    def limited(texts: Sequence[str]) -> Sequence[str]:
        box: list = []

        def work() -> None:
            try:
                box.append((call(texts), None))
            except Exception as e:  # noqa: BLE001
                box.append((None, e))

        worker = threading.Thread(target=work, daemon=True)
        worker.start()
        worker.join(timeout)
        if not box:
            raise TimeoutError(f"no reply in {timeout:g} s")
        reply, error = box[0]
        if error is not None:
            raise error
        return reply

    return limited


def generate_batch(
    df: DataFrame, prompt: str, factory: GenerateFactory, batch_rows: int = 16, timeout: float | None = 30.0
) -> DataFrame:
    """Add ``response, error``: a failed call becomes a value and the job goes on.

    A failed or late batch is asked again by halves, down to the bad prompts. ``timeout`` is in
    seconds per call.
    """
    from pyspark.sql.types import StringType, StructType

    schema = StructType([*df.schema.fields]).add("response", StringType()).add("error", StringType())

    class Client:
        """The caller's function; a new one after a late call, as the old one may still be busy with that."""

        def __init__(self) -> None:
            self.call = _timed(factory(), timeout)

        def ask(self, texts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                replies = list(self.call(texts))
                if len(replies) != len(texts):
                    raise ValueError("replies do not match prompts")
            except Exception as e:  # noqa: BLE001 - any failure of the caller's function is data here
                if isinstance(e, TimeoutError):
                    self.call = _timed(factory(), timeout)
                if len(texts) == 1:
                    return [(None, f"{type(e).__name__}: {e}")]
                half = len(texts) // 2
                return self.ask(texts[:half]) + self.ask(texts[half:])
            return [(r, None) if r else (None, "empty response") for r in replies]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = Client()
        for pdf in frames:
            for part in _chunks(pdf, batch_rows):
                pairs = client.ask(part[prompt].tolist())
                yield part.assign(response=[p[0] for p in pairs], error=[p[1] for p in pairs])

    return df.mapInPandas(run, schema)


def error_as_text(response: Column, error: Column, prefix: str = "An error occurred during LLM generation: ") -> Column:
    return F.coalesce(response, F.concat(F.lit(prefix), error))


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("error IS NULL").drop("error"), df.where("error IS NOT NULL")
