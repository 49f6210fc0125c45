"""Entity registry and the lake resolver (R1m-R3m).

Every entity of the reference (bronze / silver / gold / mart) is ONE builder
function ``fn(lake) -> DataFrame`` registered under a dotted name. The same
builder serves all three materialisations of the reference's triplets:

* ``view``  - the builder runs lazily and Catalyst inlines it into the
  consumer's plan (reference: ``v<entity>``);
* ``mv`` / ``table`` - a stored snapshot is read if the placement says the
  entity's layer is stored (reference: ``mv<entity>`` / ``t_<entity>``).

Builders read their inputs with ``lake.get(name)``, so a stored layer is
picked up by everything above it (cascade substitution, R2m) without a second
copy of any body - view/mv parity holds by construction.
"""

from __future__ import annotations

import datetime as dt
import dis
import inspect
from collections.abc import Callable
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.config import LakeConfig
from lakeworks.operators.changes import merged_state, star_changes, state_of
from lakeworks.operators.rowid import dense_row_id
from lakeworks.session import cut_lineage, passing_cuts
from lakeworks.sources.roles import Roles
from lakeworks.sources.tables import TABLES


@dataclass
class Additive:
    """An aggregate that is kept up to date from the changes of its inputs (R10m).

    ``inputs``: entity -> (columns read, columns by which two versions are first
    compared). ``rows``: frames by input -> rows to aggregate; it selects, filters
    and inner-joins, and carries the column CHANGE along where a frame has it.
    ``keys`` and ``measures`` make the additive state, ``finish(lake, state)`` the
    entity. The full build runs through the same functions."""
    inputs: dict[str, tuple[tuple, tuple]]
    rows: Callable
    keys: tuple
    measures: tuple
    finish: Callable
    live: Callable | None = None         # lake -> the rows where the inputs are made here, else None

    def frames(self, read: Callable) -> dict[str, DataFrame]:
        return {n: read(n).select(*cols) for n, (cols, _) in self.inputs.items()}

    def state(self, frames: dict[str, DataFrame]) -> DataFrame:
        return state_of(self.rows(frames), self.keys, self.measures)


@dataclass
class Entity:
    name: str
    build: Callable
    layer: str
    incremental: Additive | None = None
    table: bool = False
    cluster: tuple = ()
    partition: tuple = ()
    dated: str | None = None
    sk: str | None = None
    deps: set = field(default_factory=set)


REGISTRY: dict[str, Entity] = {}
# rows of a columnar file take several times its bytes in memory: without this a join would
# broadcast frames that are small on disk only
_FILE_GROWTH = ("spark.sql.sources.fileCompressionFactor", "8")


def additive(name: str, spec: Additive, cluster: tuple = (), partition: tuple = (), dated: str | None = None) -> None:
    """Register an entity that ``spec`` builds, in full or from changes."""
    def build(lake):
        rows = spec.live(lake) if spec.live else None
        if rows is not None:
            return spec.finish(lake, state_of(rows, spec.keys, spec.measures))
        return spec.finish(lake, spec.state(spec.frames(lambda n: lake.get(n, ids=REGISTRY[n].sk in spec.inputs[n][0]))))
    REGISTRY[name] = Entity(name, build, name.split(".", 1)[0], spec, False, tuple(cluster), tuple(partition), dated)


def entity(name: str, table: bool = False, cluster: tuple = (), partition: tuple = (), dated: str | None = None,
           sk: str | None = None):
    """Register a builder. ``table=True`` marks entities that are stored
    tables by nature (the reference maintains them with MERGE, e.g. the key
    crosswalk): the lake writes them once per session and every consumer
    scans the snapshot instead of inlining the build. ``cluster`` columns
    order rows inside each written file, so row-group statistics make
    filters on them (dates) skip data - the reference's clustering hint;
    ``partition`` columns become folders; ``dated`` names the date column of a
    fact that is stored in month folders (``Lake.between``, ``Lake.latest``). ``sk``
    names the surrogate key that readers may do without (``Lake.get(ids=False)``)."""
    layer = name.split(".", 1)[0]

    def deco(fn):
        REGISTRY[name] = Entity(name, fn, layer, None, table, tuple(cluster), tuple(partition), dated, sk)
        return fn

    return deco


PARTS: dict[str, Callable] = {}


def part_of(name: str):
    """Register the builder of an entity's parts (``Lake.part``)."""
    def deco(fn):
        PARTS[name] = fn
        return fn
    return deco


LIVE: dict[str, Callable] = {}


def live_step(name: str):
    """Register a step of :meth:`Lake.live`."""
    def deco(fn):
        LIVE[name] = fn
        return fn
    return deco


@dataclass(frozen=True)
class Placement:
    """Which layers are read from stored snapshots (R3m): S0 = nothing stored."""
    bronze: bool = False
    silver: bool = False
    gold: bool = False
    mart: bool = False

    def stored(self, layer: str) -> bool:
        return getattr(self, layer, False)


S0 = Placement()
S1 = Placement(gold=True)
S2 = Placement(silver=True)
S3 = Placement(silver=True, gold=True)
S4 = Placement(silver=True, gold=True, mart=True)


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: LakeConfig | None = None,
                 placement: Placement = S0, store=None, auto_refresh: bool = False):
        self.spark = spark
        if not spark.conf.get(_FILE_GROWTH[0], None) or spark.conf.get(_FILE_GROWTH[0]) == "1.0":
            spark.conf.set(*_FILE_GROWTH)
        self.sf_dir = sf_dir
        self.cfg = cfg or LakeConfig()
        self.roles = Roles(spark, sf_dir, self.cfg)
        self.placement = placement
        self.store = store
        self.auto_refresh = auto_refresh
        self._memo: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}
        self._star: tuple | None = None
        self._stack: list[tuple[str, bool, str]] = []  # entities being built, whether fully live, and their numbers

    def get(self, name: str, mode: str | None = None, months: tuple | None = None, ids: bool = True) -> DataFrame:
        """Resolve an entity. ``mode`` forces "view" (live, with all its inputs
        live too) or "mv"; by default the placement decides. ``months`` (two days)
        keeps a stored dated entity to the folders of those days' months. Without
        ``ids`` a live fact isn't numbered: its surrogate key is null, and nothing
        cuts the plan between its reader and the sources."""
        _load_all()
        ent = REGISTRY[name]
        if self._stack and self._stack[-1][1] and not ent.table:
            mode = "view"
        given = self._given.get(name) if ids else self._given.get(f"{name}#rows", self._given.get(name))
        if given is not None and mode is None:
            return given
        use_store = mode == "mv" or (mode is None and self.placement.stored(ent.layer))
        if use_store and self.auto_refresh and not self._require_store().exists(name):
            # cascade: a stored entity missing from the store is built once from
            # its (stored) inputs and published before anyone reads it
            self.refresh(name, log=False)
        if use_store and self.store is not None and self.store.exists(name):
            return self.store.read(name, dates=months)
        if ent.table and mode != "view":
            return self._table(name)
        ids = ids or not ent.sk
        key = name + ("#view" if mode == "view" else "") + ("" if ids else "#rows")
        if key not in self._memo:
            self._memo[key] = self._build(ent, live=mode == "view", numbers="whole" if ids else "none")
        return self._memo[key]

    @contextmanager
    def reading(self, frames: dict[str, DataFrame]):
        """Readers of these entities get the given frames while it lasts; a name with
        ``#rows`` is for readers that need no surrogate key."""
        before, self._given = self._given, {**self._given, **frames}
        try:
            yield self
        finally:
            self._given = before

    def settled(self, name: str, *columns: str):
        """A live fact that a report reads through several entities: its ``columns`` are
        written once, unnumbered, and those entities read the files (:meth:`reading`)."""
        _load_all()
        if self.placement.stored(REGISTRY[name].layer):
            return nullcontext(self)
        return self.reading({f"{name}#rows": cut_lineage(self.get(name, ids=False).select(*columns))})

    @property
    def ids(self) -> bool:
        """Whether the entity that is being built gets its surrogate key."""
        return self._stack[-1][2] != "none"

    @property
    def fully_live(self) -> bool:
        """Whether the entity that is being built reads live inputs only."""
        return bool(self._stack) and self._stack[-1][1]

    def makes(self, name: str) -> bool:
        """Whether :meth:`get` builds the entity here, from live inputs, for a builder that
        numbers its rows whole or not at all; else a version of it is read or being stored."""
        numbers, live = (self._stack[-1][2], self._stack[-1][1]) if self._stack else ("whole", False)
        read = name in self._given or f"{name}#rows" in self._given or self.placement.stored(REGISTRY[name].layer)
        return numbers != "narrow" and (live or not read)

    def live(self, step: str, *args):
        """The rows of a step that only live builds take, with fewer shuffles than the entities
        between; None where one of those is read from a version. It is found by name, so what an
        entity depends on is still read off the entities that its builder names."""
        return LIVE[step](self, *args)

    def starred(self, name: str, ids: bool, *args) -> DataFrame | None:
        """A live fact's rows with the columns of its dimensions: its builder is asked for them
        (:meth:`asked_star`)."""
        self._star = args
        try:
            return self._build(REGISTRY[name], live=self.fully_live, numbers="whole" if ids else "none")
        finally:
            self._star = None

    def asked_star(self) -> tuple | None:
        """What :meth:`starred` asks the builder for that is running, once; None for its own columns."""
        asked, self._star = self._star, None
        return asked

    def number(self, df: DataFrame, order: list[str], name: str, of: DataFrame) -> DataFrame:
        """A fact's surrogate key, by ``order``, whose combinations ``of`` holds once
        each. A fact that is being stored is numbered by its key columns alone. A live
        one is checkpointed with its numbers, since its readers go over it several times;
        it stays unnumbered for those that don't read them."""
        kind = self._stack[-1][2]
        if kind == "none":
            return df.withColumn(name, F.lit(None).cast("bigint"))
        return dense_row_id(df, order, name, of=of if kind == "narrow" else None)

    def number_rows(self, df: DataFrame, order: list, name: str) -> DataFrame:
        """As :meth:`number`, for a fact whose ``order`` isn't known to be unique: its rows
        are numbered whole, or not at all for readers that don't read the numbers."""
        return dense_row_id(df, order, name) if self.ids else df.withColumn(name, F.lit(None).cast("bigint"))

    def between(self, name: str, first: dt.date, last: dt.date) -> DataFrame:
        """Rows of a dated entity from ``first`` to ``last``, both included."""
        return self.get(name, months=(first, last)).filter(
            F.col(REGISTRY[name].dated).between(F.lit(first), F.lit(last)))

    def latest(self, name: str, ids: bool = True) -> DataFrame:
        """Rows of a dated entity on its newest date. Of a stored one only the newest
        month's folder is opened."""
        rows = self.get(name, ids=ids)           # a cascade stores it before its folders are looked at
        ent = REGISTRY[name]
        months = self.store.newest_month(name) if self.store is not None and self.placement.stored(ent.layer) else None
        if months is not None:
            rows = self.get(name, months=months, ids=ids)
        newest = rows.agg(F.max(ent.dated).alias(ent.dated))     # one row
        return rows.join(F.broadcast(newest), ent.dated, "inner").select(*rows.columns)

    def _build(self, ent: Entity, live: bool, numbers: str = "whole") -> DataFrame:
        self._stack.append((ent.name, live, numbers))
        try:
            return ent.build(self)
        finally:
            self._stack.pop()

    def invalidate(self):
        """Forget all frames, file listings included: the next ones see the
        sources as they are then."""
        self._memo.clear()
        self.roles = Roles(self.spark, self.sf_dir, self.cfg)

    def _table(self, name: str) -> DataFrame:
        """Stored-by-nature entity: reuse the snapshot written by an earlier
        lake session of this application while the source files it reads are
        unchanged (same paths, sizes and modification times), else build it."""
        key = (self.spark.sparkContext.applicationId, name, self.sf_dir, repr(self.cfg), _fingerprint(self))
        path = _TABLES.get(key)
        if path is not None:
            try:
                return self.spark.read.parquet(path)
            except Exception:  # noqa: BLE001 - snapshot folder removed: rebuild
                _TABLES.pop(key, None)
        store = self._require_store()
        version = store.current_version(name) if not self.stale(name) else self.refresh(name, log=False)
        _TABLES[key] = store._version_dir(name, version)
        return store.read(name, version)

    def part(self, name: str, *of: str) -> DataFrame:
        """Part of a stored-by-nature entity, for readers that need no more. Where the
        store holds the entity that is read; else the part alone is made, once in this
        application while the source files stay as they are."""
        label = ".".join(of)
        store = self._require_store()
        if store.exists(name):
            return self.get(name)
        key = (self.spark.sparkContext.applicationId, f"{name}@{label}", self.sf_dir, repr(self.cfg), _fingerprint(self))
        path = _TABLES.get(key)
        if path is not None:
            try:
                return self.spark.read.parquet(path)
            except Exception:  # noqa: BLE001 - snapshot folder removed: build it again
                _TABLES.pop(key, None)
        version = store.write(f"{name}@{label}", PARTS[name](self, *of))
        _TABLES[key] = store._version_dir(f"{name}@{label}", version)
        return store.read(f"{name}@{label}", version)

    # -- materialisation (R4m-R8m) ------------------------------------------
    def _require_store(self):
        if self.store is None:
            from lakeworks.plans.store import SnapshotStore
            self.store = SnapshotStore(self.spark)
        return self.store

    def refresh(self, name: str, partition_by: list[str] | None = None, log: bool = True, full: bool = False) -> int:
        """Recompute one entity from its inputs (as the placement resolves
        them) and publish it as a new snapshot version. Readers keep the old
        version until the new one is complete.

        An additive entity whose inputs are stored, and whose last version was
        made from stored versions that are still there, is refreshed from their
        changes, unless ``full``. What each version was made from is noted beside it."""
        import time
        _load_all()
        store = self._require_store()
        ent = REGISTRY[name]
        t0 = time.time()
        if not self._stack:  # inside a cascade the frames of this refresh are still good
            self.invalidate()
        # read before the build: what changes meanwhile leaves this version stale
        note = {"needs": self.needs(name), "inputs": self._stored_inputs(ent)}
        outermost = not self._stack
        with passing_cuts(self.spark) if outermost else nullcontext():
            strategy, version = self._stored_from(ent, note, partition_by, full)
        if outermost:                        # its frames read files that are gone
            self.invalidate()
        # a cascade doesn't read its results again; what isn't known counts as changed
        note["rows"], note["content"] = content_of(store.read(name, version)) if log else (None, None)
        store.write_note(name, version, {**(store.read_note(name, version) or {}), **note})  # with its layout
        if log:
            store.log_refresh(name, strategy, time.time() - t0, note["rows"], version)
        for n in {name, *dependants(name)}:
            for kind in ("", "#view", "#rows", "#view#rows"):
                self._memo.pop(n + kind, None)
        for key in [k for k in self._memo if k.startswith("#versions")]:
            del self._memo[key]
        return version

    def _stored_from(self, ent: Entity, note: dict, partition_by: list[str] | None, full: bool) -> tuple[str, int]:
        """Build an entity and write its next version: how it was made, and the version."""
        store, name, strategy = self.store, ent.name, "full"
        if ent.incremental and note["inputs"]:
            state = None if full else self._state_from_changes(ent, note["inputs"])
            strategy = "full" if state is None else "incremental"
            if state is None:
                state = ent.incremental.state(ent.incremental.frames(lambda n: store.read(n, note["inputs"][n])))
            note["state"] = store.write(f"{name}.state", state)
            df = ent.incremental.finish(self, store.read(f"{name}.state", note["state"]))
        else:
            df = self._build(ent, live=False, numbers="narrow")
        return strategy, store.write(name, df, partition_by or list(ent.partition), dated=ent.dated, cluster=ent.cluster)

    def _stored_inputs(self, ent: Entity) -> dict[str, int] | None:
        """Current stored versions of an additive entity's inputs; None if one is live."""
        if not ent.incremental:
            return None
        out = {}
        for n in ent.incremental.inputs:
            if not self.placement.stored(REGISTRY[n].layer):
                return None
            if self.auto_refresh and not self.store.exists(n):
                self.refresh(n, log=False)
            out[n] = self.store.current_version(n)
        return None if None in out.values() else out

    def _state_from_changes(self, ent: Entity, inputs: dict[str, int]) -> DataFrame | None:
        """The last version's state brought up to date, or None if it can't be."""
        store, spec = self.store, ent.incremental
        last = store.current_version(ent.name)
        note = store.read_note(ent.name, last) if last else None
        if not note or not note.get("state") or set(note["inputs"] or ()) != set(inputs):
            return None
        then = note["inputs"]
        if not all(store.complete(n, v) for n, v in then.items()) or not store.complete(f"{ent.name}.state", note["state"]):
            return None
        moved = [n for n in inputs if inputs[n] != then[n] and (
            store.content(n, inputs[n]) is None or store.content(n, inputs[n]) != store.content(n, then[n]))]
        state = store.read(f"{ent.name}.state", note["state"])
        old, new = (spec.frames(lambda n, at=at: store.read(n, at[n])) for at in (then, inputs))
        rows = star_changes(spec.rows, old, new, {n: spec.inputs[n][1] for n in moved})
        return state if rows is None else merged_state(state, state_of(rows, spec.keys, spec.measures), spec.keys)

    # -- staleness (R7m) ------------------------------------------------------
    def needs(self, name: str, tables: bool = True) -> dict[str, str]:
        """What an entity's content depends on: files of the source tables that it
        reads live, and the content of the stored entities below it. A table that
        isn't in the store (or without ``tables``, any) counts by its own needs."""
        out = {f"source:{t}": p for t, p in _source_prints(self).items() if t in source_tables(name)}
        for d in sorted(dependencies(name)):
            by_content = self.store is not None and self._is_stored(d) and (tables or not REGISTRY[d].table)
            known = self.store.content(d) if by_content else None
            if known is not None:
                out[d] = known
            else:
                out |= self.needs(d, tables)
        return out

    def _is_stored(self, name: str) -> bool:
        return REGISTRY[name].table or self.placement.stored(REGISTRY[name].layer)

    def stale(self, name: str) -> list[str]:
        """Why the stored version of an entity is out of date; empty if it isn't."""
        store = self._require_store()
        last = store.current_version(name)
        note = store.read_note(name, last) if last else None
        if note is None:
            return ["missing"]
        # tables may have come into the store since
        found = []
        for tables in (True, False):
            now, then = self.needs(name, tables), note["needs"]
            found.append(sorted(k for k in now.keys() | then.keys() if now.get(k) != then.get(k)))
        return min(found, key=len)

    def freshness(self) -> DataFrame:
        """One row per entity of the stored layers: version, state (fresh, stale,
        missing), and what has changed below it. An entity above a stale one is
        stale as well: its input will change."""
        _load_all()
        reasons: dict[str, list[str]] = {}
        for n in self.stored_names():
            below = [f"{d} is stale" for d in sorted(dependencies(n)) if reasons.get(d)]
            reasons[n] = self.stale(n) + below
        rows = [(n, self.store.current_version(n), "fresh" if not r else "missing" if "missing" in r else "stale", ", ".join(r))
                for n, r in reasons.items()]
        return self.spark.createDataFrame(rows, "entity string, version int, state string, reasons string")

    def stored_inputs(self, names) -> set[str]:
        """``names`` and all stored entities below them."""
        _load_all()
        return set(names) | {d for n in names for d in _below(n) if self._is_stored(d)}

    def stored_names(self, names=None) -> list[str]:
        """Stored entities, or those of ``names`` and the tables below them."""
        if names is not None:
            names = set(names) | {d for n in names for d in _below(n) if REGISTRY[d].table}
        return [n for n in dependency_order() if self._is_stored(n) and (names is None or n in names)]

    def refresh_stale(self, names=None, workers: int = 1) -> DataFrame:
        """Refresh the stored entities (or ``names`` of them) that are out of
        date, inputs first: entity, action, reason, seconds.

        An entity whose inputs were rebuilt with the same content stays as it is.
        Entities of one dependency level don't read each other and are refreshed
        by ``workers`` jobs at a time, each in a scheduler pool of its own. After
        a failure only what depends on it is left out (``blocked``)."""
        import time
        from concurrent.futures import ThreadPoolExecutor
        _load_all()
        self._require_store()
        self.invalidate()
        wanted = self.stored_names(names)
        level: dict[str, int] = {}
        for n in wanted:
            level[n] = 1 + max((level[d] for d in _stored_below(n, set(wanted))), default=-1)
        done: dict[str, tuple] = {}

        def one(n: str) -> tuple:
            t0 = time.time()
            blocked = [d for d in _stored_below(n, set(wanted)) if done[d][1] in ("failed", "blocked")]
            if blocked:
                return n, "blocked", ", ".join(blocked), 0.0
            why = self.stale(n)
            if not why:
                return n, "fresh", "", time.time() - t0
            try:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"refresh-{n}")
                worker = Lake(self.spark, self.sf_dir, self.cfg, self.placement, self.store, self.auto_refresh)
                worker.refresh(n)
            except Exception as e:  # noqa: BLE001 - kept to the entities above this one
                return n, "failed", str(e).split("\n")[0][:200], time.time() - t0
            finally:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            return n, "refreshed", ", ".join(why), time.time() - t0

        for k in range(max(level.values(), default=-1) + 1):
            own = [n for n in wanted if level[n] == k]
            with ThreadPoolExecutor(max(1, min(workers, len(own)))) as pool:
                done.update((r[0], r) for r in pool.map(one, own))
        self.invalidate()
        return self.spark.createDataFrame([done[n] for n in wanted], "entity string, action string, reason string, seconds double")

    def refresh_layer(self, layer: str) -> list[str]:
        names = [n for n in dependency_order() if REGISTRY[n].layer == layer]
        for n in names:
            self.refresh(n)
        return names

    def refresh_all(self, layers=("bronze", "silver", "gold", "mart")) -> DataFrame:
        """Refresh every stored layer bottom-up; returns (layer, seconds) rows (R6m)."""
        import time
        out = []
        for layer in layers:
            t0 = time.time()
            self.refresh_layer(layer)
            out.append((layer, float(time.time() - t0)))
        return self.spark.createDataFrame(out, "layer string, seconds double")


_TABLES: dict[tuple, str] = {}


def content_of(df: DataFrame) -> tuple[int, str]:
    """Row count, and a checksum of the rows in any order."""
    marked = [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*marked).cast("decimal(38,0)")), F.sum(F.hash(*marked).cast("long"))).first()
    return r[0], f"{r[0]}:{r[1]}:{r[2]}"


def _fingerprint(lake) -> tuple:
    """(path, length, modification time) of every file of the driver tables, in
    folders of any depth."""
    from lakeworks.sources.tables import table_path
    jvm = lake.spark.sparkContext._jvm
    conf = lake.spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in TABLES:
        p = jvm.org.apache.hadoop.fs.Path(table_path(lake.sf_dir, t))
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                st = files.next()
                out.append((t, st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out))


def _source_prints(lake) -> dict[str, str]:
    """Per driver table a checksum of its files' names, lengths and times, and of
    the settings; read once in a lake's life between two invalidations."""
    if "#prints" not in lake._memo:
        import hashlib
        files = _fingerprint(lake)
        lake._memo["#prints"] = {t: hashlib.sha256(repr((lake.cfg, [f for f in files if f[0] == t])).encode()).hexdigest()[:16]
                                 for t in TABLES}
    return lake._memo["#prints"]


def _load_all():
    # importing the layer modules registers their builders
    from lakeworks.plans import bronze, gold, mart, silver  # noqa: F401


def _reached(ent: Entity) -> tuple[list, set[str]]:
    """Constants and names in the code of a builder and of the functions of these
    modules that it uses."""
    spec = ent.incremental
    seen, names, values, todo = set(), set(), [], [ent.build] if not spec else [spec.rows, spec.finish]
    if spec:
        values += list(spec.inputs)
    while todo:
        f = todo.pop()
        code = getattr(f, "__code__", None)
        if code is None or f in seen or not f.__module__.startswith("lakeworks.plans"):
            continue
        seen.add(f)
        own = [c.cell_contents for c in f.__closure__ or ()] + list(f.__defaults__ or ())
        codes = [code]
        while codes:
            c = codes.pop()
            own += c.co_consts
            names |= set(c.co_names)
            codes += [x for x in c.co_consts if hasattr(x, "co_consts")]
            used = {i.argval for i in dis.get_instructions(c) if i.opname == "LOAD_GLOBAL"}
            own += [f.__globals__[n] for n in sorted(used) if n in f.__globals__]
        values += own
        todo += [v for v in own if callable(v)]
    return values, names


def dependencies(name: str) -> set[str]:
    """Entities a builder names: read off the code of the builder and of the
    functions of these modules that it uses, so they are known before anything
    has run. Reads of a whole group (a name made from a pattern) count as all
    entities the group's list holds."""
    ent = REGISTRY[name]
    if ent.deps:
        return ent.deps
    short = {n.split(".", 1)[1]: n for n in REGISTRY}
    found = set()
    for v in _reached(ent)[0]:
        if isinstance(v, str) and v in REGISTRY:
            found.add(v)
        elif isinstance(v, (list, tuple, dict)):
            found |= {x if x in REGISTRY else short[x] for x in v
                      if isinstance(x, str) and (x in REGISTRY or x in short)}
    rank = {layer: k for k, layer in enumerate(LAYERS)}
    ent.deps = {n for n in found - {name} if rank.get(REGISTRY[n].layer, 9) <= rank.get(ent.layer, 9)}
    return ent.deps


def source_tables(name: str) -> set[str]:
    """Driver tables that a builder itself reads, by the raw frames it names (a
    list of frames, as the crosswalk's key columns, counts with all it holds)."""
    values, names = _reached(REGISTRY[name])
    frames = vars(Roles)
    names |= {x for v in values if isinstance(v, list) for t in v if isinstance(t, tuple) for x in t if isinstance(x, str)}
    out, seen, todo = set(), set(), [n for n in names if n in frames] + [t for t in names if t in TABLES and "t" in names]
    while todo:
        n = todo.pop()
        if n in seen:
            continue
        seen.add(n)
        if n in TABLES:
            out.add(n)
        f = frames.get(n)
        f = inspect.unwrap(getattr(f, "func", None) or getattr(f, "__func__", f))
        codes = [f.__code__] if hasattr(f, "__code__") else []
        while codes:
            c = codes.pop()
            todo += [x for x in c.co_names if x in TABLES or x in frames]
            codes += [x for x in c.co_consts if hasattr(x, "co_consts")]
    return out


def _below(name: str) -> set[str]:
    """All entities that ``name`` reads, directly or through others."""
    out: set[str] = set()
    todo = [name]
    while todo:
        new = dependencies(todo.pop()) - out
        out |= new
        todo += new
    return out


def _stored_below(name: str, names: set[str]) -> set[str]:
    """Nearest entities under ``name`` that are among ``names``."""
    out: set[str] = set()
    todo, seen = list(dependencies(name)), set()
    while todo:
        d = todo.pop()
        if d in seen:
            continue
        seen.add(d)
        if d in names:
            out.add(d)
        else:
            todo += dependencies(d)
    return out


def dependants(name: str) -> set[str]:
    """Entities that read ``name``, directly or through others."""
    out: set[str] = set()
    todo = [name]
    while todo:
        n = todo.pop()
        new = {m for m in REGISTRY if n in dependencies(m)} - out
        out |= new
        todo += new
    return out


LAYERS = ("bronze", "silver", "gold", "mart")


def dependency_order(names=None) -> list[str]:
    """Topological order of registered entities (R5m), inputs first."""
    _load_all()
    names = list(names or REGISTRY)
    rank = {layer: k for k, layer in enumerate(LAYERS)}
    out, seen = [], set()

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in sorted(dependencies(n)):
            visit(d)
        out.append(n)

    for n in sorted(names, key=lambda n: (rank.get(REGISTRY[n].layer, 9), n)):
        visit(n)
    return out
