"""What sources have to say about their input, collected while a run builds them.

A source notes an observation of a pass that runs anyway, such as the write of a staged table; the run asks
for the numbers when the source's rows are stored. Outside a run nothing listens and nothing is computed.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Observation

_heard: ContextVar[list[Observation] | None] = ContextVar("notes", default=None)


@contextmanager
def noting() -> Iterator[list[Observation]]:
    """The observations noted inside; each must belong to a pass that has run by the end."""
    heard: list[Observation] = []
    token = _heard.set(heard)
    try:
        yield heard
    finally:
        _heard.reset(token)


def note(observation: Observation) -> None:
    heard = _heard.get()
    if heard is not None:
        heard.append(observation)


def numbers(heard: list[Observation]) -> dict[str, int]:
    return {name: value for observation in heard for name, value in observation.get.items()}
