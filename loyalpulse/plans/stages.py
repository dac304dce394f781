"""Wall-clock of the stages of a run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple


class Stage(NamedTuple):
    name: str
    seconds: float


class StageLog(list[Stage]):
    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        start = time.perf_counter()
        yield
        self.append(Stage(name, time.perf_counter() - start))
