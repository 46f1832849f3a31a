"""Models that label texts: one for each worker, asked in batches of about the same length, whose failures are rows.

A backend is picklable and says how a model is loaded; the model takes texts and
gives an answer for each. Backends are known by name, so that a job can name
the one that it wants.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[Sequence[str]], Sequence[str | None]]


class Backend(Protocol):
    """What a model comes from. The key tells whether a worker has it already."""

    key: str

    def load(self) -> Model:
        """Loads the model, once in a worker."""


BACKENDS: dict[str, Callable[..., Backend]] = {}


def backend(name: str):
    """Registers what makes a backend under a name."""

    def keep(make: Callable[..., Backend]) -> Callable[..., Backend]:
        BACKENDS[name] = make
        return make

    return keep


def build(name: str, **options) -> Backend:
    if name not in BACKENDS:
        raise ValueError(f"no backend is called {name!r}; there are {', '.join(sorted(BACKENDS))}")
    return BACKENDS[name](**options)


@dataclass(frozen=True)
class Terms:
    """A stand-in without a model: the first label one of whose terms is in a text, in the order of the labels; else the other one."""

    labels: tuple[tuple[str, tuple[str, ...]], ...]
    other: str = "other"
    key: str = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "key", f"terms:{self.labels}:{self.other}")

    def load(self) -> Model:
        def answer(text: str) -> str:
            low = text.lower()
            return next((label for label, terms in self.labels if any(t in low for t in terms)), self.other)

        return lambda texts: [answer(t) for t in texts]


backend("terms")(Terms)

_loaded: dict[str, Model] = {}


def _model(source: Backend) -> Model:
    """The model of a worker; another backend takes its place, so that only one is held."""
    if source.key not in _loaded:
        _loaded.clear()
        _loaded[source.key] = source.load()
    return _loaded[source.key]


@dataclass(frozen=True)
class Asking:
    """How a model is asked: texts and characters of a batch at most, tries of a call, and seconds before the second try, doubled each time."""

    texts: int = 32
    characters: int = 16_384
    tries: int = 3
    wait: float = 1.0


def batches_by_length(lengths: Sequence[int], asking: Asking) -> Iterator[list[int]]:
    """Places of texts in batches: sorted by length, so that little is padded; one that is too long is a batch of its own."""
    some: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        # All are padded to the longest, which is the one that comes.
        if some and (len(some) == asking.texts or (len(some) + 1) * lengths[i] > asking.characters):
            yield some
            some = []
        some.append(i)
    if some:
        yield some


def _asked(model: Model, texts: list[str], asking: Asking) -> list[tuple[str | None, str | None]]:
    """(answer, reason) of each text: a batch that fails each time is asked text by text, so that one that can't be answered spoils no other."""
    reason = ""
    for k in range(asking.tries):
        try:
            answers = list(model(texts))
            if len(answers) != len(texts):
                raise ValueError(f"{len(answers)} answers to {len(texts)} texts")
            return [(a, None if a is not None else "no_answer") for a in answers]
        except Exception as e:
            reason = f"{type(e).__name__}: {e}"[:200]
            if k < asking.tries - 1:
                time.sleep(min(60.0, asking.wait * 2**k))
    if len(texts) == 1:
        return [(None, reason)]
    return [x for t in texts for x in _asked(model, [t], asking)]


def label(df: DataFrame, text: str, source: Backend, out: str = "label", asking: Asking = Asking()) -> DataFrame:  # noqa: B008
    """df with out, a model's answer to each text, and out_reason, why there is none.

    A null text is not asked (missing_text), nor is one without anything but
    white space (empty_text); a model that gives nothing is told as no_answer,
    one that fails as its error. Rows that repeat a text are asked each on their
    own; an empty table gives an empty result. Columns of df with such names are
    replaced.
    """
    made = (out, f"{out}_reason")
    kept = [c for c in df.columns if c.lower() not in {m.lower() for m in made}]
    cell = lambda c: F.col("`" + c.replace("`", "``") + "`")
    wide = df.select(F.struct(*map(cell, kept)).alias("_row"), cell(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            told: list[tuple[str | None, str | None]] = [(None, "missing_text" if t is None else "empty_text") for t in texts]
            asked = [i for i, t in enumerate(texts) if t is not None and t.strip()]
            for some in batches_by_length([len(texts[i]) for i in asked], asking):
                places = [asked[k] for k in some]
                for i, x in zip(places, _asked(_model(source), [texts[i] for i in places], asking), strict=True):
                    told[i] = x
            answers = [pa.array([t[k] for t in told], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *answers], ["_row", *made])

    schema = T.StructType([wide.schema["_row"], *[T.StructField(m, T.StringType()) for m in made]])
    return wide.mapInArrow(run, schema).select("_row.*", *made)
