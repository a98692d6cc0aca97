"""Model catalog: each model is a function from :class:`Tables` to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the record source written into every vault row.
RECORD_SOURCE = "OULAD"


@dataclass(frozen=True)
class Unhashed:
    """Rows of a vault model whose hashes are still to be taken.

    ``rows`` have the parts of the hashes in columns of their own (``_...``) and all other columns,
    ``hashes`` are the hash columns as expressions over them, ``columns`` those of the model. A hash is
    32 random bytes, its parts are a few: what moves rows moves the parts, and hashes where they are.
    Rows with equal parts are the rows with equal hashes. With ``repeats`` rows may still come twice.
    """

    rows: DataFrame
    hashes: Mapping[str, Column]
    columns: Sequence[str]
    repeats: bool = False

    @property
    def parts(self) -> list[str]:
        return [c for c in self.rows.columns if c.startswith("_")]

    def frame(self) -> DataFrame:
        rows = self.rows.distinct() if self.repeats else self.rows
        return rows.select(
            *[self.hashes[c].alias(c) if c in self.hashes else c for c in self.columns])

    def placed(self, key: str, null: Column, width: int | None = None) -> DataFrame:
        """The rows where the bytes of their ``key`` are, which they have from there on, as well as those
        of their hashdiff. A NULL key becomes ``null``. Rows that come twice still do, side by side."""
        made = F.coalesce(F.unhex(self.hashes[key]), null)
        diff = {c: F.unhex(h) for c, h in self.hashes.items() if c == "hk_hashdiff"}
        return self.rows.repartition(*([width] if width else []), made).withColumns({key: made, **diff})


@dataclass(frozen=True)
class Model:
    """How a model is built, stored and checked.

    ``kind`` is ``view`` (never stored), ``table`` (full refresh), ``upsert`` (by ``key``) or
    ``append`` (new versions of ``key``). ``non_null`` and ``unique`` are its inline assertions.
    """

    name: str
    layer: str
    kind: str
    build: Callable[[Tables], DataFrame]
    key: tuple[str, ...] = ()
    non_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()


MODELS: dict[str, Model] = {}


def model(layer: str, kind: str = "table", key: tuple[str, ...] = (),
          non_null: tuple[str, ...] = (), unique: tuple[str, ...] = ()):
    """Register the decorated function as the model of the same name. It gives the model's rows, or
    these unhashed."""
    def register(fn: Callable[[Tables], DataFrame | Unhashed]) -> Callable[[Tables], DataFrame]:
        @wraps(fn)
        def build(t: Tables) -> DataFrame:
            made = fn(t)
            return made.frame() if isinstance(made, Unhashed) else made

        build.unhashed = fn
        MODELS[fn.__name__] = Model(fn.__name__, layer, kind, build, key, non_null, unique)
        return build
    return register


class Tables:
    """Frames by name: given ones are returned as they are, models are built on first use.

    A given frame may also be a function that makes it, called when the frame is first used, and a
    frame or what the function returns may be unhashed.

    ``load_ts`` stamps vault rows. ``all_versions=True`` lets business views join every satellite
    version instead of the latest one (sums then multiply after a second load).
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 load_ts: datetime, all_versions: bool = False):
        self._frames = dict(frames)
        self._unhashed: dict[str, Unhashed] = {}
        self.load_ts = load_ts
        self.all_versions = all_versions

    def __getitem__(self, name: str) -> DataFrame:
        made = self._frames.get(name)
        if made is None:
            if name not in MODELS:
                raise KeyError(f"no table or model named {name!r}")
            build = MODELS[name].build
            made = getattr(build, "unhashed", build)(self)
        elif not isinstance(made, DataFrame | Unhashed):
            made = made()
        if isinstance(made, Unhashed):
            self._unhashed[name], made = made, made.frame()
        self._frames[name] = made
        return made

    def unhashed(self, name: str) -> Unhashed | None:
        """The rows of a model before they are hashed; None where only hashed ones are known, as of
        stored tables."""
        self[name]
        return self._unhashed.get(name)

    def with_frames(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                    **changes) -> Tables:
        """Copy in which the given frames replace models or tables; the rest is rebuilt."""
        base = {k: v for k, v in self._frames.items() if k not in MODELS}
        return Tables({**base, **frames}, changes.get("load_ts", self.load_ts),
                      changes.get("all_versions", self.all_versions))

    @property
    def stamp(self) -> list[Column]:
        """Load date and record source of vault rows."""
        return [
            F.lit(self.load_ts).cast("timestamp").alias("dv_load_date"),
            F.lit(RECORD_SOURCE).alias("dv_source"),
        ]
