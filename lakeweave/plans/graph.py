"""The models of a build as a graph that their own code defines.

A model is a function of the tables it reads. ``analyse`` calls every function once with lazy frames and records the
tables it asks for: these are the edges, and no job runs. The order of a build, the models above or below
a selection and the partitioning that a model inherits from its parents follow from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakeweave.operators.partitions import common_partitioning
from lakeweave.specs import PartitionDef

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """How a table's rows follow from other tables, and how they are loaded.

    ``view_of`` names the table that the model shows as it is; ``partitions`` are the source's own, where it
    is loaded by partition.
    """

    rows: Callable[[Tables], DataFrame]
    partition_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    overwrite: bool = False
    view_of: str | None = None
    partitions: tuple[PartitionDef, ...] | None = None


class _Asked(Mapping):
    """Lazy frames by name; remembers which were asked for."""

    def __init__(self, frame: Callable[[str], DataFrame]):
        self.frame, self.names = frame, []

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            self.names.append(name)
        return self.frame(name)

    def __iter__(self):
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


class ModelGraph:
    """Parents of every model (``parents``), found by ``analyse``; ``also`` adds edges that checks need."""

    def __init__(self, models: Mapping[str, Model], also: Iterable[tuple[str, str]] = ()):
        self.models = dict(models)
        self.parents: dict[str, tuple[str, ...]] = {}
        self._frames: dict[str, DataFrame] = {}
        self._open: list[str] = []
        for name in self.models:
            self._frame(name)
        self.needs = {name: set(own) for name, own in self.parents.items()}
        for child, parent in also:
            if child in self.needs and parent in self.models and child != parent:
                self.needs[child].add(parent)
        self.partitions = self._inherited()

    def _frame(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        if name in self._open:
            raise ValueError("models read each other: " + " -> ".join([*self._open[self._open.index(name) :], name]))
        if name not in self.models:
            raise ValueError(f"{self._open[-1] if self._open else 'a selection'} reads {name}, which is no model")
        self._open.append(name)
        asked = _Asked(self._frame)
        self._frames[name] = self.models[name].rows(asked)
        self._open.pop()
        self.parents[name] = tuple(asked.names)
        return self._frames[name]

    def _inherited(self) -> dict[str, tuple[PartitionDef, ...] | None]:
        """Partitioning of every model: its own, or that of its partitioned parents, which must agree."""
        out: dict[str, tuple[PartitionDef, ...] | None] = {}
        for name in self.order():
            try:
                found = common_partitioning({p: out[p] for p in self.parents[name]})
            except ValueError as e:
                raise ValueError(f"{name}: {e}") from None
            own = self.models[name].partitions
            if own and found and own != found:
                raise ValueError(f"{name} is partitioned otherwise than its parents")
            out[name] = own or found
        return out

    def order(self, only: Iterable[str] | None = None) -> list[str]:
        """Models so that each comes after all it needs, otherwise as they were given."""
        wanted = set(self.models if only is None else only)
        done: list[str] = []
        while len(done) < len(wanted):
            ready = [n for n in self.models if n in wanted and n not in done and not (self.needs[n] & wanted) - set(done)]
            if not ready:
                raise ValueError(f"checks need each other's models: {sorted(wanted - set(done))}")
            done.append(ready[0])
        return done

    def select(self, names: Sequence[str], upstream: bool = False, downstream: bool = False) -> list[str]:
        """The named models, and all above or below them, in build order."""
        if unknown := sorted(set(names) - set(self.models)):
            raise ValueError(f"no such models: {unknown}")
        chosen = set(names)
        if upstream:
            todo = list(names)
            while todo:
                new = set(self.parents[todo.pop()]) - chosen
                chosen |= new
                todo += new
        if downstream:
            below = set(names)
            for name in self.order():
                if below & set(self.parents[name]):
                    below.add(name)
            chosen |= below
        return self.order(chosen)
