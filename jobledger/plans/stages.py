"""A named, ordered list of stages.

The same list serves two uses:

* ``apply(df)`` composes ``DataFrame -> DataFrame`` stages lazily with
  ``DataFrame.transform`` into one logical plan (Catalyst optimises across
  stage boundaries); the first stage in the list runs first.
* ``wrap(handler)`` wraps a job handler in middleware ``fn(job, next)``;
  the first middleware in the list is the outermost, so its "before" code
  runs first and its "after" code last.

Names: ``add`` appends (an unnamed stage gets ``middleware-<len>``, so names
can repeat after a removal), ``prepend`` puts in front, ``insert_before`` /
``insert_after`` place next to the first stage with that name or append when
there is none, ``remove`` drops the first stage with that name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class StageChain:
    stages: list[tuple[str, Callable]] = field(default_factory=list)

    def add(self, fn: Callable, name: str | None = None) -> "StageChain":
        self.stages.append((name if name is not None else f"middleware-{len(self.stages)}", fn))
        return self

    def prepend(self, name: str, fn: Callable) -> "StageChain":
        self.stages.insert(0, (name, fn))
        return self

    def _index(self, name: str) -> int | None:
        for i, (n, _) in enumerate(self.stages):
            if n == name:
                return i
        return None

    def insert_before(self, existing: str, name: str, fn: Callable) -> "StageChain":
        i = self._index(existing)
        if i is None:
            return self.add(fn, name)
        self.stages.insert(i, (name, fn))
        return self

    def insert_after(self, existing: str, name: str, fn: Callable) -> "StageChain":
        i = self._index(existing)
        if i is None:
            return self.add(fn, name)
        self.stages.insert(i + 1, (name, fn))
        return self

    def remove(self, name: str) -> "StageChain":
        i = self._index(name)
        if i is not None:
            del self.stages[i]
        return self

    def names(self) -> list[str]:
        return [n for n, _ in self.stages]

    def apply(self, df):
        for _, fn in self.stages:
            df = df.transform(fn)
        return df

    def wrap(self, handler: Callable) -> Callable:
        h = handler
        for _, mw in reversed(self.stages):
            def layer(job, _mw=mw, _next=h):
                return _mw(job, _next)
            h = layer
        return h
