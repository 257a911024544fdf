"""Summary store on Parquet: batches append deltas, readers merge them.

Every measure is a max or a sum, so an update needs no read-modify-write:

    deltas/<table>/batch_id=<id>/[day=<day>/]   one fold of one batch
    commits/<id>                                written last: the batch counts from now on
    base/<build>/<table>/[day=<day>/]           deltas folded together by compact()
    base/<build>_covered/                       ids of the batches inside that base
    versions/<number>                           written last, by one build only: holds its name
    cubes/<id>                                  counted events of a batch, while it is folded
    staged/<id>                                 a batch whose events are kept in staged_rows/<id> until they are folded;
                                                batches <id>.<n> staged together lie in staged_rows/<id>/batch=<n>
    groups/<fold>                               the ids of staged batches that one fold takes together

A batch that fails half-way leaves no commit and is rewritten by its retry; a batch that
is committed already is skipped.  No file a reader may hold is ever overwritten.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch import schemas as s
from realmwatch.functions.times import day_label
from realmwatch.operators import slices
from realmwatch.operators.lists import KEY
from realmwatch.operators.merge import combine, slice_rules
from realmwatch.plans.folders import Folder


# The column that tells batches apart which are staged together, and their names.
PART = "batch"
_MEMBER = re.compile(r"(.+-\d{10})\.(\d+|__HIVE_DEFAULT_PARTITION__)")


def _staged_as(batch_id: str) -> tuple[str, str | None]:
    """The name a batch is staged under, and which of the batches under that name it is."""
    member = _MEMBER.fullmatch(batch_id)
    return (member[1], member[2]) if member else (batch_id, None)


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    keys: list[str]
    how: dict[str, str] | str = "max"
    daily: bool = False

    @property
    def stored(self) -> T.StructType:
        extra = [T.StructField("day", T.StringType())] if self.daily else []
        return T.StructType([*self.schema.fields, *extra])


def _daily(schema: T.StructType, keys: list[str]) -> Table:
    return Table(schema, keys, slice_rules(schema.names, keys), daily=True)


TABLES = {
    "client": Table(s.CLIENT, ["ip"]),
    "princ": Table(s.PRINC, ["name"]),
    "client_cname_sname": Table(s.CCS, ["ip", "cname", "sname"]),
    "req_enctypes_lists": Table(s.LISTS, KEY),
    "report_counts": Table(s.REPORT_COUNTS, ["reason", "kept"], {"nlines": "sum"}),
    "client_average_data": Table(
        s.CLIENT_AVERAGES, ["ip", "is_success", "period"],
        {"last_start": "max"} | dict.fromkeys(["nentries", *s.CLIENT_COUNTS], "sum"),
    ),
    "client_slice_data": _daily(s.CLIENT_SLICES, slices.KEYS["client"]),
    "princ_slice_data": _daily(s.PRINC_SLICES, slices.KEYS["princ"]),
    "ccs_slice_data": _daily(s.CCS_SLICES, slices.KEYS["ccs"]),
}


@dataclass(frozen=True)
class Snapshot:
    """What a reader sees: one base version and the batches committed since."""

    version: str | None
    batches: list[str] = field(default_factory=list)


class SummaryStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = Folder(spark, root)

    # -- writing ---------------------------------------------------------------------

    def is_committed(self, batch_id: str) -> bool:
        if self.folder.exists("commits", batch_id):
            return True
        version = self._version()
        return version is not None and not self._covered(version).where(
            F.col("batch_id") == batch_id
        ).isEmpty()

    def write_delta(self, table: str, delta: DataFrame, batch_id: str) -> None:
        """Write one fold of one batch, replacing what a failed attempt left."""
        path = self.folder.at("deltas", table, f"batch_id={batch_id}")
        self._write(TABLES[table], delta, path)

    def commit(self, batch_id: str) -> None:
        self.folder.mark("commits", batch_id)

    def is_taken(self, batch_id: str) -> bool:
        """Whether a batch is staged or committed, so that its events are not read again."""
        return self.folder.exists("staged", batch_id) or self.is_committed(batch_id)

    def stage(self, events: DataFrame, batch_id: str) -> int:
        """Keep the events of a batch until they are folded with those of others.

        Events with a column `batch` are those of several batches, `<batch_id>.<batch>`, which are staged in folders of
        their own and count from one moment on.  Gives the number of batches.
        """
        writer = events.write.mode("overwrite")
        if PART in events.columns:
            writer = writer.partitionBy(PART)
        writer.parquet(self.folder.at("staged_rows", batch_id))
        self.folder.mark("staged", batch_id)
        return len(self._members(batch_id))

    def _members(self, staged: str) -> list[str]:
        """The batches that were staged together under this name; one with no events to part has none but itself."""
        parts = [n for n in self.folder.names("staged_rows", staged) if n.startswith(f"{PART}=")]
        return [f"{staged}.{p.removeprefix(f'{PART}=')}" for p in parts] or [staged]

    def staged(self, source: str) -> list[str]:
        """Batches of a source that wait for their fold; what a crash left of the last fold is settled or dropped."""
        for fold in self.folder.names("groups"):
            if fold.rpartition("-of-")[0].rpartition("-")[0] != source:
                continue
            if self.is_committed(fold):
                self.settle(fold)
            else:
                for name in TABLES:
                    self.folder.remove("deltas", name, f"batch_id={fold}")
                self.folder.remove("groups", fold)
        waiting = [b for b in self.folder.names("staged") if b.rpartition("-")[0] == source]
        return [member for b in waiting for member in self._members(b)]

    def read_staged(self, batches: list[str], schema: T.StructType) -> DataFrame:
        root = self.folder.at("staged_rows")
        paths = [f"{root}/{name}/{PART}={part}" if part else f"{root}/{name}" for name, part in map(_staged_as, batches)]
        return self.spark.read.schema(schema).parquet(*paths)

    def group(self, batches: list[str]) -> str:
        """The name of the fold of staged batches; another one if a retry finds more of them."""
        fold = f"{batches[-1]}-of-{len(batches)}"
        self.folder.claim("\n".join(batches), "groups", fold)
        return fold

    def settle(self, fold: str) -> None:
        """Mark the batches of a committed fold, which have no deltas of their own, and drop their events."""
        batches = [_staged_as(b) for b in self.folder.text("groups", fold).split("\n")]
        for name, part in batches:
            if part:
                self.folder.remove("staged_rows", name, f"{PART}={part}")
        for name in dict.fromkeys(name for name, _ in batches):
            if self._members(name) == [name]:  # of what was staged together another fold may still hold some
                self.commit(name)
                self.folder.remove("staged", name)
                self.folder.remove("staged_rows", name)
        self.folder.remove("groups", fold)

    def _write(self, table: Table, rows: DataFrame, path: str) -> None:
        if table.daily:
            # sizes the files per day at run time, splitting heavy days
            dated = rows.withColumn("day", day_label(F.col("starttime")))
            dated.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    # -- reading ---------------------------------------------------------------------

    def _version(self) -> str | None:
        """The build that the newest version names.

        A marker is empty while it is claimed, and stays so if its writer dies then: it does not count.
        """
        for number in reversed(self.folder.names("versions")):
            if build := self.folder.text("versions", number):
                return build
        return None

    def _covered(self, version: str) -> DataFrame:
        return self.spark.read.schema("batch_id string").parquet(
            self.folder.at("base", f"{version}_covered")
        )

    def snapshot(self) -> Snapshot:
        # commits are listed before the version: a batch compacted in between is then
        # found covered rather than missed
        commits = self.folder.names("commits")
        version = self._version()
        if version is not None and commits:
            marked = self.spark.createDataFrame([(c,) for c in commits], "batch_id string")
            fresh = marked.join(self._covered(version), "batch_id", "left_anti")
            commits = sorted(r.batch_id for r in fresh.collect())
        return Snapshot(version, commits)

    def read(
        self,
        name: str,
        days: int | None = None,
        as_of: int | None = None,
        at: Snapshot | None = None,
    ) -> DataFrame:
        """The merged table.  `days` and `as_of` prune slice tables, by partition."""
        table, seen = TABLES[name], at or self.snapshot()
        parts = self._deltas(name, seen.batches)
        if seen.version is not None:
            base = self.folder.at("base", seen.version, name)
            parts = parts.unionByName(self.spark.read.schema(table.stored).parquet(base))
        if table.daily and days is not None:
            if as_of is None:
                raise ValueError("pruning by days needs as_of")
            oldest = F.lit(as_of - days * s.DAY_SECONDS)
            parts = slices.prune(parts.where(F.col("day") >= day_label(oldest)), days, as_of)
        return combine(parts.select(*table.schema.names), table.keys, table.how)

    def _deltas(self, name: str, batches: list[str]) -> DataFrame:
        """Committed deltas of a table as one scan, batch ids being a partition column."""
        table = TABLES[name]
        root = self.folder.at("deltas", name)
        written = set(self.folder.names("deltas", name))
        present = [f"batch_id={b}" for b in batches if f"batch_id={b}" in written]
        if not present:
            return self.spark.createDataFrame([], table.stored)
        schema = T.StructType([*table.stored.fields, T.StructField("batch_id", T.StringType())])
        scan = self.spark.read.schema(schema).option("basePath", root)
        return scan.parquet(*[f"{root}/{p}" for p in present]).drop("batch_id")

    def read_rates(self, name: str, days: int | None = None, as_of: int | None = None) -> DataFrame:
        """A merged slice table with its rates; those of counts that no batch filled are NULL."""
        return slices.slice_rates(self.read(name, days, as_of))

    # -- maintenance -----------------------------------------------------------------

    def compact(self, days: int | None = None, as_of: int | None = None) -> str | None:
        """Fold everything committed into a new base, leaving out slices past retention.

        Every build has folders of its own.  The version after the one it started from is
        claimed last; if another compaction has claimed it meanwhile, this build is discarded
        and None returned.
        """
        numbers = self.folder.names("versions")
        number = f"{int(numbers[-1] if numbers else 0) + 1:010d}"
        seen = self.snapshot()
        version = f"{number}-{uuid.uuid4().hex}"
        covered = self.spark.createDataFrame([(b,) for b in seen.batches], "batch_id string")
        if seen.version is not None:
            covered = covered.unionByName(self._covered(seen.version))
        covered.write.mode("overwrite").parquet(self.folder.at("base", f"{version}_covered"))
        for name, table in TABLES.items():
            merged = self.read(name, days, as_of, at=seen)
            self._write(table, merged, self.folder.at("base", version, name))
        if self.folder.claim(version, "versions", number):
            return version
        self._drop_base(version)
        return None

    def _drop_base(self, version: str) -> None:
        self.folder.remove("base", version)
        self.folder.remove("base", f"{version}_covered")

    def vacuum(self) -> None:
        """Delete bases and deltas that the current version has replaced.

        Call it when no reader still holds an older snapshot.
        """
        numbers = self.folder.names("versions")
        if not numbers:
            return
        fresh = set(self.snapshot().batches)
        for batch in self.folder.names("commits"):
            if batch not in fresh:
                for name in TABLES:
                    self.folder.remove("deltas", name, f"batch_id={batch}")
                self.folder.remove("commits", batch)
        current = self._version()
        for number in numbers[:-1]:
            build = self.folder.text("versions", number)
            if build == current:
                break
            if build:
                self._drop_base(build)
            self.folder.remove("versions", number)
