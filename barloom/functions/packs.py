"""Feature packs: named functions from table to table with declared inputs and outputs, ordered by what they need, and arbitrary Python per key."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class PackError(ValueError):
    """A pack that is declared twice, lacks what it needs, or does not do what it declares."""


@dataclass(frozen=True)
class Pack:
    """gives: columns with their types that the pack adds to a table that has the columns in needs."""

    name: str
    needs: tuple[str, ...]
    gives: dict[str, str]
    apply: Callable[[DataFrame], DataFrame]


class Packs:
    """A registry of packs."""

    def __init__(self, keys: tuple[str, ...] = ("ticker", "date")):
        self.keys, self.packs = keys, dict[str, Pack]()

    def add(self, pack: Pack) -> Pack:
        taken = {c: p.name for p in self.packs.values() for c in p.gives}
        if pack.name in self.packs:
            raise PackError(f"{pack.name} is declared twice")
        for c in pack.gives:
            if c in taken or c in self.keys:
                raise PackError(f"{pack.name} gives {c}, which {taken.get(c, 'the key')} has")
        self.packs[pack.name] = pack
        return pack

    def table(self, name: str, needs: Iterable[str], gives: dict[str, str]) -> Callable:
        """Registers a function of a DataFrame that returns it with the columns given."""
        return lambda f: self.add(Pack(name, tuple(needs), dict(gives), f))

    def per_key(self, name: str, needs: Iterable[str], gives: dict[str, str], key: str = "ticker", order: str = "date") -> Callable:
        """Registers a function of an Arrow table, the rows of one key in order with the columns needed, that returns the columns given for these rows, in their order.

        It gets a key's whole history at once (`applyInArrow`), so it is for histories that fit a task; the rest of the library's windows have no such bound."""

        def wrap(f: Callable[[pa.Table], pa.Table]) -> Pack:
            columns = list(dict.fromkeys([*self.keys, *needs]))

            def apply(df: DataFrame) -> DataFrame:
                wanted = StructType([df.schema[c] for c in self.keys]).simpleString()[7:-1].replace(":", " ") + "".join(f", {c} {t}" for c, t in gives.items())

                def run(t: pa.Table) -> pa.Table:
                    t = t.sort_by([(order, "ascending"), *((k, "ascending") for k in self.keys if k not in (key, order))])
                    got = f(t)
                    if got.num_rows != t.num_rows:
                        raise PackError(f"{name} gives {got.num_rows} rows for {t.num_rows}")
                    return pa.table([t.column(k) for k in self.keys] + [got.column(c) for c in gives], [*self.keys, *gives])

                added = df.select(*[F.col(f"`{c}`") for c in columns]).groupBy(key).applyInArrow(run, wanted)
                return df.join(added, list(self.keys), "left")

            return self.add(Pack(name, tuple(needs), dict(gives), apply))

        return wrap

    def ordered(self, have: Iterable[str], wanted: Iterable[str] | None = None) -> list[Pack]:
        """The packs that are needed for the wanted columns (all packs, if None), each after those whose columns it needs; by name where that leaves a choice."""
        have, giver = set(have), {c: p for p in self.packs.values() for c in p.gives}
        out: list[Pack] = []
        doing: list[str] = []

        def visit(p: Pack) -> None:
            if p in out:
                return
            if p.name in doing:
                raise PackError(f"packs need each other: {' -> '.join([*doing[doing.index(p.name):], p.name])}")
            doing.append(p.name)
            for c in p.needs:
                if c not in have:
                    if c not in giver:
                        raise PackError(f"{p.name} needs {c}, which nothing gives")
                    visit(giver[c])
            doing.pop()
            out.append(p)

        if wanted is None:
            roots = [self.packs[n] for n in sorted(self.packs)]
        else:
            if missing := [c for c in wanted if c not in have and c not in giver]:
                raise PackError(f"nothing gives {', '.join(missing)}")
            roots = sorted({giver[c].name: giver[c] for c in wanted if c not in have}.values(), key=lambda p: p.name)
        for p in roots:
            visit(p)
        return out

    def apply(self, df: DataFrame, wanted: Iterable[str] | None = None) -> DataFrame:
        """df with the columns of the packs that are needed. Each pack must add exactly the columns it declares, with their types, and keep all others."""
        wanted = None if wanted is None else list(wanted)
        for p in self.ordered(df.columns, wanted):
            if clash := [c for c in p.gives if c in df.columns]:
                raise PackError(f"{p.name} gives {', '.join(clash)}, which the table has")
            got = p.apply(df)
            added = {c: t for c, t in got.dtypes if c not in df.columns}
            declared = {c: StructType.fromDDL(f"x {t}")["x"].dataType.simpleString() for c, t in p.gives.items()}
            if added != declared or not set(df.columns) <= set(got.columns):
                raise PackError(f"{p.name} declares {declared} and adds {added}")
            df = got.select(*[F.col(f"`{c}`") for c in df.columns], *p.gives)
        return df
