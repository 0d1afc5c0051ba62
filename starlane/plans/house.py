"""The tables of the warehouse under one root folder, read through its commits.

    location_dim, car_dim, date_dim
    customer_current/run=<run>/bucket=<n>  current versions of the buckets that a run touched
    customer_closed/<run>               the versions a run ended, never changed again
    customer_past/run=<run>/bucket=<n>  the state of the ended versions of a touched bucket's customers
    customer_buckets/<run>              per bucket the runs that hold it, and what the checks count there
    customer_keys/<run>                 the range of the keys that a run gave out
    customer_seen/<run>                 the customers of a run's batch
    customer_dropped/<run>              keys of older versions that a late run has replaced
    fact_moves/<run>                    keys in older facts that a late run has replaced, and for which days
    rentals_fact/<run>                  a run's day of the fact
    indicators/<run>, tickets/<run>     what the indicators add up from a run's day
    rejects/<run>                       the rentals that the run left out, and why
    checks/<run>                        what the run's checks counted
    commits/<number>                    one file per finished run: its day and folders

A run writes only folders named by itself, so neither a run that fails nor one that is
repeated touches what is visible; a run's folders, in all tables, become visible with its
commit. A commit's file is created only if its number is free, so of two runs that started from the
same state one commits and the other is told. Commits are a stack: one for a day takes the
lines of that day and of later ones out of sight, with all that came behind the first of
these; a late one goes on top and hides nothing. ``vacuum`` deletes folders out of sight.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.operators import kpi_state, version_state
from starlane.operators.late import MOVES, move_keys
from starlane.schemas import CAR_DIM, CUSTOMER_DIM, DATE_DIM, DATED_FACT, LOCATION_DIM
from starlane.session import create_new, list_folders, remove_path

COMMIT = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("ds", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("late", T.BooleanType()),
])
REJECT = T.StructType([
    T.StructField("rental_id", T.StringType()),
    T.StructField("missing_fields", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("batch_date", T.DateType()),
])
CHECK = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("violations", T.LongType()),
])
BUCKET = T.StructType([
    T.StructField("bucket", T.IntegerType()),
    T.StructField("current_run", T.StringType()),
    T.StructField("past_run", T.StringType()),
    *[T.StructField(name, T.LongType()) for name in version_state.VIOLATIONS],
])
KEYS = T.StructType([
    T.StructField("lowest", T.LongType()),
    T.StructField("highest", T.LongType()),
    T.StructField("repeated", T.LongType()),
])
SEEN = T.StructType([T.StructField("customer_id", T.StringType())])
DROPPED = T.StructType([T.StructField("customer_key", T.LongType())])

PARTS = [T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())]
FIRST = "none"  # the run that holds the bucket list of a new warehouse
BUCKETS = 64
RUN_TABLES = (
    "customer_current", "customer_closed", "customer_past", "customer_buckets", "customer_keys", "customer_seen",
    "customer_dropped", "fact_moves", "rentals_fact", "indicators", "tickets", "rejects", "checks",
)


class Commit(NamedTuple):
    number: int
    ds: str
    run: str
    late: bool = False


class ConflictError(RuntimeError):
    """Another run has committed since this one began; run the day again."""


def bucket_of(customer_id: str, buckets: int):
    return F.pmod(F.xxhash64(customer_id), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def read_runs(self, name: str, schema: T.StructType, runs: Sequence[str]) -> DataFrame:
        """A table's rows from the folders of these runs."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(f"{name}/{run}") for run in runs])

    # Commits: one short file per run, read by the driver.

    def lines(self) -> list[Commit]:
        """All lines ever written, in order; a half-written one is none yet."""
        found = self.spark.read.schema(COMMIT).json(self.path("commits")).dropna().collect()
        return sorted(Commit(*r) for r in found)

    def commits(self) -> list[Commit]:
        """The lines in sight, in the order they were written."""
        seen: list[Commit] = []
        for line in self.lines():
            seen = [*(seen if line.late else _below(seen, line.ds)), line]
        return seen

    def before(self, ds: str) -> list[Commit]:
        """What a run of this day goes on from."""
        return _below(self.commits(), ds)

    def last_number(self) -> int:
        return max((line.number for line in self.lines()), default=0)

    def commit(self, ds: str, run: str, base: int | None = None, late: bool = False) -> None:
        """Makes a run visible, unless another has committed since number ``base``."""
        number = (self.last_number() if base is None else base) + 1
        line = json.dumps({"number": number, "ds": ds, "run": run, "late": late})
        if not create_new(self.spark, self.path(f"commits/{number:012}.json"), line + "\n"):
            raise ConflictError(f"commit {number} is taken, {run} stays out of sight")

    # Customers.

    def buckets(self, commits: Sequence[Commit]) -> list:
        """The list of buckets after these commits; its length is fixed with the warehouse."""
        run = commits[-1].run if commits else FIRST
        return sorted(self.read_runs("customer_buckets", BUCKET, [run]).collect())

    def read_buckets(self, name: str, schema: T.StructType, held: Sequence[tuple[str, int]]) -> DataFrame:
        """The buckets given by run and number; one without rows has no run."""
        by_run: dict[str, list[int]] = {}
        for run, bucket in held:
            if run:
                by_run.setdefault(run, []).append(bucket)
        if not by_run:
            return self.spark.createDataFrame([], schema)
        rows = (
            self.spark.read.schema(T.StructType([*schema.fields, *PARTS])).option("basePath", self.path(name))
            .parquet(*[self.path(f"{name}/run={run}") for run in by_run])
        )
        # Partition columns, so that only these buckets' files are read.
        wanted = [(F.col("run") == run) & F.col("bucket").isin(buckets) for run, buckets in by_run.items()]
        return rows.filter(reduce(lambda a, b: a | b, wanted)).select(schema.fieldNames())

    def read_current(self, lines: Sequence) -> DataFrame:
        return self.read_buckets("customer_current", CUSTOMER_DIM, [(x.current_run, x.bucket) for x in lines])

    def read_past(self, lines: Sequence) -> DataFrame:
        return self.read_buckets("customer_past", version_state.STATE, [(x.past_run, x.bucket) for x in lines])

    def current_customers(self, commits: Sequence[Commit]) -> DataFrame:
        return self.read_current(self.buckets(commits))

    def ended_customers(self, commits: Sequence[Commit]) -> DataFrame:
        """Ended versions, without those that late runs have replaced since."""
        versions, together = self.read_runs("customer_closed", CUSTOMER_DIM, []), []
        for line in commits:
            if line.late:
                versions = versions.unionByName(self.read_runs("customer_closed", CUSTOMER_DIM, together))
                dropped = self.read_runs("customer_dropped", DROPPED, [line.run])
                versions, together = versions.join(dropped, "customer_key", "left_anti").select(versions.columns), []
            together.append(line.run)
        closed = self.read_runs("customer_closed", CUSTOMER_DIM, together)
        return versions.unionByName(closed) if any(line.late for line in commits) else closed

    def customers(self, commits: Sequence[Commit]) -> DataFrame:
        return self.current_customers(commits).unionByName(self.ended_customers(commits))

    def customer_dim(self, ds: str | None = None) -> DataFrame:
        """All versions after day ``ds``, by default after the last day."""
        commits = self.commits()
        if ds is not None:
            later = [i for i, c in enumerate(commits) if c.ds > ds]
            commits = commits[:later[0]] if later else commits
        return self.customers(commits)

    def highest_key(self, commits: Sequence[Commit]) -> int:
        return self.read_runs("customer_keys", KEYS, [c.run for c in commits]).agg(F.max("highest")).first()[0] or 0

    # The other tables.

    def fact(self) -> DataFrame:
        """All days in sight, with the keys that late runs have put right."""
        rows, together, commits = self.read_runs("rentals_fact", DATED_FACT, []), [], self.commits()
        for line in commits:
            if line.late:
                rows = rows.unionByName(self.read_runs("rentals_fact", DATED_FACT, together))
                rows, together = move_keys(rows, self.read_runs("fact_moves", MOVES, [line.run])), []
            together.append(line.run)
        last = self.read_runs("rentals_fact", DATED_FACT, together)
        return rows.unionByName(last) if any(line.late for line in commits) else last

    def rejects(self) -> DataFrame:
        return self.read_runs("rejects", REJECT, [c.run for c in self.commits()])

    def checks(self) -> DataFrame:
        """The checks of the last run in sight."""
        return self.read_runs("checks", CHECK, [c.run for c in self.commits()[-1:]])

    def indicators(self) -> kpi_state.States:
        """What the indicators add up from, over all days in sight; no fact is read."""
        runs = [c.run for c in self.commits()]
        return kpi_state.States(
            self.read_runs("indicators", kpi_state.STATE, runs), self.read_runs("tickets", kpi_state.TICKETS, runs)
        )

    def fixed_dimensions(self) -> dict[str, DataFrame]:
        return {
            "car_dim": self.read("car_dim", CAR_DIM),
            "location_dim": self.read("location_dim", LOCATION_DIM),
            "date_dim": self.read("date_dim", DATE_DIM),
        }

    def dimensions(self, ds: str | None = None) -> dict[str, DataFrame]:
        return {**self.fixed_dimensions(), "customer_dim": self.customer_dim(ds)}


def _below(seen: Sequence[Commit], ds: str) -> list[Commit]:
    """The lines under the first one of this day or a later one."""
    out = []
    for line in seen:
        if line.ds >= ds:
            break
        out.append(line)
    return out


def vacuum(house: Warehouse) -> list[str]:
    """Delete folders of runs out of sight; no run may be under way. Names the folders."""
    seen = {FIRST, *(c.run for c in house.commits())}
    gone = []
    for name in RUN_TABLES:
        for run in list_folders(house.spark, house.path(name)):
            if run.removeprefix("run=") not in seen:
                remove_path(house.spark, house.path(f"{name}/{run}"))
                gone.append(f"{name}/{run}")
    return gone
