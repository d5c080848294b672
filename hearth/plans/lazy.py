"""A read-only mapping of tables built on first access.

PySpark analyses every DataFrame as it is built, so constructing a whole
layer when a caller needs one table costs driver time for nothing.  Layers
return a ``LazyTables``; each entry is a function of the mapping itself, so
dependencies between tables resolve on demand and each table is built once.
Names starting with ``__`` are internal (shared intermediate results) and are
not listed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping):
    def __init__(self, builders: dict[str, Callable[["LazyTables"], DataFrame]] | None = None,
                 ready: Mapping[str, DataFrame] | None = None):
        self._builders = dict(builders or {})
        self._built: dict[str, DataFrame] = dict(ready or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._builders:
                raise KeyError(name)
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def _names(self) -> list[str]:
        return [n for n in dict.fromkeys([*self._builders, *self._built]) if not n.startswith("__")]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names())

    def __len__(self) -> int:
        return len(self._names())
