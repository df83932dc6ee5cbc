"""Tables with a key, stored in buckets by its hash.

``<path>/data/_commit=<id>/_bucket=<number>`` holds rows of one bucket that one
commit wrote; files are never changed.  ``<path>/log`` (see ``commits``) tells
for every bucket which of them make it up: its base, which has one row a key,
and changes that came after it, oldest first, where the last row of a key
counts.  Rows without a key lie in bucket -1, which only grows.

A writer touches the buckets of its batch and no others: it reads those alone,
writes those whose rows changed, and every other bucket keeps its files.  What
it read belongs to one commit; if another writer's commit came first, its own
still stands when their buckets differ, and is worked out anew when they meet.

The schema belongs to the commit, with a version that every change of it counts
up; how it may change is said in ``evolution``.

A commit also remembers the last batch number of each writer it contains, so a
batch that is written again after a failure changes nothing, whatever else
happened to the table in between.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators.dedup import last_wins
from ticketlake.operators.lookups import plan_bytes
from ticketlake.operators.merge import ACTION, merged_rows
from ticketlake.session import scratch_dir
from ticketlake.sources.commits import ATTEMPTS, CommitLog, Conflict, Folder
from ticketlake.sources.evolution import SchemaConflict, default_of, evolved, with_metadata

BUCKET_BYTES = 256 * 1024 * 1024
LEAST_BUCKETS, MOST_BUCKETS = 4, 1 << 15  # a bitmap of buckets has so many bits
LOOSE = -1
COUNTED = ("insert", "update", "unchanged")


@dataclass
class State:
    """What a commit says about the table."""

    number: int
    buckets: int
    schema: T.StructType
    base: dict[int, str] = field(default_factory=dict)
    changes: dict[int, list[str]] = field(default_factory=dict)
    loose: list[str] = field(default_factory=list)
    bytes: dict[int, int] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    version: int = 1  # of the schema

    def with_schema(self, schema: T.StructType, **changes) -> State:
        return replace(self, schema=schema, version=self.version + (schema != self.schema), **changes)

    def content(self, changed: Iterable[int] | None) -> dict:
        """``changed``: the buckets this commit is about, None for all."""
        return {
            "buckets": self.buckets,
            "schema": self.schema.json(),
            "version": self.version,
            "base": self.base,
            "changes": self.changes,
            "loose": self.loose,
            "bytes": self.bytes,
            "applied": self.applied,
            "changed": None if changed is None else sorted(changed),
        }

    @staticmethod
    def of(number: int, content: dict) -> State:
        numbered = lambda d: {int(k): v for k, v in d.items()}
        return State(
            number,
            content["buckets"],
            T.StructType.fromJson(json.loads(content["schema"])),
            numbered(content["base"]),
            numbered(content["changes"]),
            content["loose"],
            numbered(content["bytes"]),
            content["applied"],
            content.get("version", 1),
        )

    def parts(self) -> set[tuple[str, int]]:
        """Every (commit id, bucket) the state is made of."""
        found = {(c, b) for b, c in self.base.items()} | {(c, b) for b, cs in self.changes.items() for c in cs}
        return found | {(c, LOOSE) for c in self.loose}


def bucket_of(key: str | Column, buckets: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key.isNull(), LOOSE).otherwise(F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int"))


def stored_fields(rows: DataFrame) -> T.StructType:
    """The columns as files give them back: nullable, without metadata."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])


def bucket_bitmap(bucket: Column, where: Column | None = None) -> Column:
    """Aggregate: which buckets occur, as a bitmap that the driver can hold."""
    bucket = F.when((bucket != LOOSE) & (F.lit(True) if where is None else where), bucket)
    return F.bitmap_construct_agg(F.bitmap_bit_position(bucket + 1))


def bits(bitmap: bytes | None) -> list[int]:
    return [8 * k + j for k, byte in enumerate(bitmap or b"") for j in range(8) if byte >> j & 1]


def known_bytes(rows: DataFrame) -> int:
    """Catalyst's size estimate, 0 if it knows nothing; a table that turns out larger gets more buckets afterwards."""
    size, unknown = plan_bytes(rows), rows.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    return size if size < unknown else 0


def fitting_buckets(size: int) -> int:
    """A power of two, so that a bucket has about ``BUCKET_BYTES``."""
    buckets = LEAST_BUCKETS
    while buckets < MOST_BUCKETS and buckets * BUCKET_BYTES < size:
        buckets *= 2
    return buckets


def _assert_fits(lost: Observation) -> None:
    bad = {c: n for c, n in lost.get.items() if n}
    if bad:
        raise SchemaConflict(f"values that do not fit their declared types: {bad}")


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str = "sys_id", sort_by: str | None = None):
        self.spark, self.path, self.key, self.sort_by = spark, path.rstrip("/"), key, sort_by
        self.log = CommitLog(spark, f"{self.path}/log")
        self.data = Folder(spark, f"{self.path}/data")

    # -- reading --------------------------------------------------------------

    def state(self, number: int | None = None) -> State | None:
        """The newest state, or an earlier one that is still there."""
        number, content = self.log.latest() if number is None else (number, self.log.read(number))
        return State.of(number, content) if content else None

    def _rows(self, state: State, parts: Iterable[tuple[str, int]]) -> DataFrame:
        """Rows of some parts, with ``_commit`` and ``_bucket``."""
        paths = [f"{self.data.path}/_commit={c}/_bucket={b}" for c, b in sorted(parts)]
        schema = T.StructType([*state.schema, T.StructField("_commit", T.StringType()), T.StructField("_bucket", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.data.path).parquet(*paths)

    def versions(self, state: State, buckets: Iterable[int] | None = None) -> DataFrame:
        """All row versions of some buckets (default: all) that have a key; the greatest ``_commit`` counts."""
        wanted = set(state.base) | set(state.changes) if buckets is None else set(buckets)
        return self._rows(state, {p for p in state.parts() if p[1] in wanted and p[1] != LOOSE})

    def rows(self, state: State, buckets: Iterable[int] | None = None) -> DataFrame:
        """Current rows with a key, and ``_bucket``.  Only buckets with changes are worked on."""
        wanted = set(state.base) | set(state.changes) if buckets is None else set(buckets)
        plain = self.versions(state, wanted - set(state.changes)).drop("_commit")
        open_ = wanted & set(state.changes)
        if not open_:
            return plain
        folded = last_wins(self.versions(state, open_), self.key, ["_commit"]).drop("_commit")
        return plain.unionByName(folded) if wanted - open_ else folded

    def read(self, state: State | None = None) -> DataFrame | None:
        """The table as of now (or of a state), None if there is none."""
        state = state or self.state()
        if state is None:
            return None
        out = self.rows(state)
        if state.loose:
            out = out.unionByName(self._rows(state, {(c, LOOSE) for c in state.loose}).drop("_commit"))
        return out.select(*state.schema.names)

    # -- writing --------------------------------------------------------------

    def _write(self, number: int, rows: DataFrame) -> tuple[str, dict[int, int]]:
        """Store rows with ``_bucket`` under a new commit id; the id and the bytes of each bucket."""
        name = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        order = [c for c in ["_bucket", self.sort_by] if c in rows.columns]
        path = f"{self.data.path}/_commit={name}"
        rows.sortWithinPartitions(*order).write.partitionBy("_bucket").parquet(path)
        found = [int(n.split("=")[1]) for n in self.data.children(f"_commit={name}") if n.startswith("_bucket=")]
        return name, {b: self.data.size(f"_commit={name}/_bucket={b}") for b in found}

    def _discard(self, name: str, buckets: Iterable[int] | None = None) -> None:
        if buckets is None:
            self.data.delete(f"_commit={name}")
        else:
            for b in buckets:
                self.data.delete(f"_commit={name}/_bucket={b}")

    def _commit(self, seen: int, change: Callable[[State | None], State], touched: set[int] | None) -> State:
        """Put ``change`` on top of the newest state, if nobody changed the touched buckets after commit ``seen``."""
        while True:
            number, content = self.log.latest()
            for other in range(seen + 1, number + 1):
                changed = self.log.read(other)["changed"]
                if touched is None or changed is None or touched & set(changed):
                    raise Conflict(f"{self.path}: commit {other} changed the same buckets")
            seen = number
            state = change(State.of(number, content) if content else None)
            if self.log.claim(number + 1, state.content(touched)):
                return replace(state, number=number + 1)

    def _retried(self, work: Callable):
        for attempt in range(ATTEMPTS):
            try:
                return work()
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
                time.sleep(random.uniform(0, 0.1 * (attempt + 1)))
        raise AssertionError

    def replace(
        self,
        rows: DataFrame,
        buckets: int | None = None,
        based_on: State | None = None,
        check: Callable[[], None] | None = None,
    ) -> State:
        """A new complete state with one row a key.

        ``based_on`` is the state the rows were made from: a commit after it is a
        conflict.  Without it the rows replace whatever is there.  ``check`` is
        called when they are written and may forbid that they count.
        """
        buckets = buckets or fitting_buckets(known_bytes(rows))
        number = (based_on.number if based_on else self.log.latest()[0]) + 1
        name, sizes = self._write(number, rows.withColumn("_bucket", bucket_of(self.key, buckets)).repartition("_bucket"))
        kept = sorted(b for b in sizes if b != LOOSE)
        fields = with_metadata(stored_fields(rows), based_on.schema if based_on else None)
        try:
            if check is not None:
                check()
        except SchemaConflict:
            self._discard(name)
            raise

        def change(state: State | None) -> State:
            return State(
                0, buckets, fields, dict.fromkeys(kept, name), {}, [name] if LOOSE in sizes else [], sizes,
                state.applied if state else {}, state.version + (fields != state.schema) if state else 1,
            )

        while True:
            seen = based_on.number if based_on else self.log.latest()[0]
            try:
                return self._commit(seen, change, None)
            except Conflict:
                if based_on is not None:
                    self._discard(name)
                    raise

    def _staged(self, batch: DataFrame, buckets: int) -> tuple[DataFrame, set[int]]:
        """A batch, read once and kept by bucket while it is merged, and its buckets."""
        folder = Folder(self.spark, scratch_dir(self.spark, "staged"))
        batch.withColumn("_bucket", bucket_of(self.key, buckets)).write.partitionBy("_bucket").parquet(folder.path)
        found = {int(n.split("=")[1]) for n in folder.children() if n.startswith("_bucket=")}
        rows = self.spark.read.schema(batch.schema).parquet(folder.path).select(*batch.columns)
        return rows, found - {LOOSE}

    def actions(self, batch: DataFrame, order: list[str] | None = None) -> DataFrame:
        """What a merge of the batch makes of the table: every row with its action."""
        state = self.state()
        if state is None:
            raise ValueError(f"{self.path} holds no table")
        batch, touched = self._staged(batch, state.buckets)
        out = merged_rows(self.rows(state, touched), batch, self.key, order, bucket_of(self.key, state.buckets))
        rest = self.rows(state, (set(state.base) | set(state.changes)) - touched)
        loose = self._rows(state, {(c, LOOSE) for c in state.loose}).drop("_commit")
        kept = rest.unionByName(loose).withColumn(ACTION, F.lit("keep"))
        return out.unionByName(kept, allowMissingColumns=True).drop("_bucket")

    def merge(
        self,
        batch: DataFrame,
        order: list[str] | None = None,
        touched: tuple[int, Iterable[int]] | None = None,
        writer: str | None = None,
        number: int | None = None,
        declared: T.StructType | None = None,
    ) -> dict[str, int]:
        """Upsert a batch; returns how many rows were inserted, updated, unchanged.

        ``touched`` names the batch's buckets if they are known, and the number
        of buckets they are counted by; otherwise the batch is staged by bucket.
        Either way the batch and its buckets of the table are read once.  A
        batch whose ``number`` the table contains changes nothing.

        ``declared`` columns are there afterwards, in types that hold the
        declared ones.  Those the batch lacks keep their value in rows that are
        there, and have their default in new ones.
        """
        if declared is not None:
            self.evolve(declared)
        held = (batch, *touched) if touched else (batch, None, ())

        def work() -> dict[str, int]:
            nonlocal held
            state = self.state()
            if state and writer is not None and state.applied.get(writer, -1) >= number:
                return dict.fromkeys(COUNTED, 0)
            if state and held[1] != state.buckets:
                staged, found = self._staged(batch, state.buckets)
                held = staged, state.buckets, found
            rows, _, known = held
            read = set(known) - {LOOSE} if state else set()
            buckets = state.buckets if state else fitting_buckets(known_bytes(batch))
            merged = merged_rows(self.rows(state, read) if state else None, rows, self.key, order, bucket_of(self.key, buckets))
            filled = {}
            for f in declared or []:
                if f.name not in rows.columns:
                    old = F.col(f.name) if f.name in merged.columns else F.lit(None).cast(f.dataType)
                    filled[f.name] = F.when(F.col(ACTION) == "insert", F.expr(default_of(f))).otherwise(old)
            merged = merged.withColumns(filled) if filled else merged
            fields = with_metadata(stored_fields(merged.drop(ACTION, "_bucket")), state.schema if state else declared)
            seen, action = Observation(), F.col(ACTION)
            counts = [F.count_if(action == a).alias(a) for a in COUNTED]
            changed = bucket_bitmap(F.col("_bucket"), action.isin("insert", "update")).alias("changed")
            before = state.number if state else 0
            name, sizes = self._write(before + 1, merged.observe(seen, *counts, changed).drop(ACTION))
            told = seen.get
            changed = set(bits(told["changed"])) & set(sizes)
            self._discard(name, set(sizes) - changed - {LOOSE})  # read, and as they were
            result = {a: told[a] for a in COUNTED}
            evolved = state is None or fields != state.schema
            if not (changed or LOOSE in sizes or evolved or writer is not None):
                self._discard(name)
                return result

            def change(now: State | None) -> State:
                now = now or State(0, buckets, fields)
                return now.with_schema(
                    fields,
                    base={**now.base, **dict.fromkeys(changed, name)},
                    changes={b: c for b, c in now.changes.items() if b not in changed},
                    loose=now.loose + [name] * (LOOSE in sizes),
                    bytes={**now.bytes, **{b: sizes[b] for b in changed}},
                    applied={**now.applied, **({writer: number} if writer is not None else {})},
                )

            try:
                self._commit(before, change, None if evolved else read)
            except Conflict:
                self._discard(name)
                raise
            return result

        counts = self._retried(work)
        self._grow()
        return counts

    def evolve(self, declared: T.StructType) -> State | None:
        """Give a table the declared columns and types; the newest state, None if there is no table.

        New columns and wider types are a commit without data.  Text that
        becomes a type is the only rewrite; a value that does not fit is an
        error, and then nothing has changed.
        """

        def work() -> State | None:
            state = self.state()
            if state is None:
                return None
            fields, anew = evolved(state.schema, declared)
            if fields == state.schema:
                return state
            if not anew:
                return self._commit(state.number, lambda now: now.with_schema(fields), None)
            as_files, _ = evolved(state.schema, T.StructType([f for f in declared if f.name not in anew]))
            typed = {c: F.col(c).try_cast(fields[c].dataType) for c in anew}
            seen = Observation()
            lost = [F.count_if(F.col(c).isNotNull() & value.isNull()).alias(c) for c, value in typed.items()]
            rows = self.read(replace(state, schema=as_files)).observe(seen, *lost).withColumns(typed)
            return self.replace(rows, state.buckets, based_on=state, check=partial(_assert_fits, seen))

        return self._retried(work)

    def add_changes(
        self,
        make: Callable[[DataFrame | None], DataFrame],
        touched: Iterable[int],
        columns: list[str],
        writer: str,
        number: int,
        buckets: int,
    ) -> int:
        """Put changes beside the buckets they belong to, without rewriting those; returns the bytes written.

        ``make`` gets the named columns of every row version in the touched
        buckets, ``_commit`` included, and gives the rows to add, one a key.  A
        number the table contains already adds nothing.
        """
        touched = set(touched) - {LOOSE}

        def work() -> int:
            state = self.state()
            if state and state.applied.get(writer, -1) >= number:
                return 0
            if state and state.buckets != buckets:
                raise ValueError("buckets are numbered for another state")
            rows = make(self.versions(state, touched).select(*columns, "_commit") if state else None)
            known = state.schema.names if state else []
            added = [f for f in stored_fields(rows) if f.name not in known]
            fields = T.StructType([*(state.schema if state else []), *added])
            given = set(rows.columns)
            rows = rows.select(*[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
            rows = rows.withColumn("_bucket", bucket_of(self.key, buckets)).repartition("_bucket")
            name, sizes = self._write((state.number if state else 0) + 1, rows)
            changed = set(sizes) - {LOOSE}

            def change(now: State | None) -> State:
                now = now or State(0, buckets, fields)
                return now.with_schema(
                    fields,
                    changes={**now.changes, **{b: [*now.changes.get(b, []), name] for b in changed}},
                    loose=now.loose + [name] * (LOOSE in sizes),
                    bytes={**now.bytes, **{b: now.bytes.get(b, 0) + sizes[b] for b in changed}},
                    applied={**now.applied, writer: number},
                )

            try:
                whole = state is None or bool(added)
                self._commit(state.number if state else 0, change, None if whole else touched)
            except Conflict:
                self._discard(name)
                raise
            return sum(sizes.values())

        return self._retried(work)

    def pending(self, state: State | None = None) -> int:
        """The greatest number of changes that lie beside one bucket."""
        state = state or self.state()
        return max(map(len, state.changes.values()), default=0) if state else 0

    def compact(self, least: int = 1) -> None:
        """Fold the changes of every bucket that has at least ``least`` of them into its base."""

        def work() -> None:
            state = self.state()
            full = {b for b, c in state.changes.items() if len(c) >= least} if state else set()
            if not full:
                return
            name, sizes = self._write(state.number + 1, self.rows(state, full).repartition("_bucket"))

            def change(now: State) -> State:
                return replace(
                    now,
                    base={**now.base, **{b: name for b in full}},
                    changes={b: c for b, c in now.changes.items() if b not in full},
                    bytes={**now.bytes, **sizes},
                )

            try:
                self._commit(state.number, change, full)
            except Conflict:
                self._discard(name)
                raise

        self._retried(work)

    def _grow(self) -> None:
        """More buckets once they are twice as large as they should be; the only rewrite of everything."""

        def work() -> None:
            state = self.state()
            wanted = fitting_buckets(sum(state.bytes.values()))
            if wanted > 2 * state.buckets:
                self.replace(self.read(state), wanted, based_on=state)

        self._retried(work)

    def vacuum(self, keep: int = 10) -> int:
        """Remove commits older than the newest ``keep`` and the parts only they are made of; returns how many parts."""
        numbers = self.log.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        if not old:
            return 0
        gone = set().union(*(self.state(n).parts() for n in old)) - set().union(*(self.state(n).parts() for n in kept))
        for commit, bucket in gone:
            self.data.delete(f"_commit={commit}/_bucket={bucket}")
        for commit in {c for c, _ in gone}:
            if not any(n.startswith("_bucket=") for n in self.data.children(f"_commit={commit}")):
                self.data.delete(f"_commit={commit}")
        for number in old:
            self.log.forget(number)
        return len(gone)
