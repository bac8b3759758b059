"""Current state (one row per key) as an append-only table of runs over a base.

Every load adds its rows, one per key, as one run; nothing is rewritten, so the cost of a
load follows its own size. Rows count in the order of their day, and inside a day of their
merge, so that a day that is loaded late or again takes its place among the others. The state
is the last row of each key over a base and the runs merged after it, with rows deactivated
that a later full snapshot covers; a recovery tells the state by the same rule.

Runs lie in one folder per hour of their merge, a base in one folder per bucket of its keys. A
read lists the hours since its base and no others, and with keys it opens only their buckets;
renewing the base from time to time keeps both from growing with the age of the table. Repeating
a run under its name replaces its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.history import replay_state
from lakeops.schema import stored_schema
from lakeops.sinks.files import append_run, existing_folders, remove_folders, run_folder

#: of a moment as part of a folder's name; names sort like the moments
MOMENT, HOUR = "%Y%m%dT%H%M%S.%f", "%Y%m%dT%H"
BUCKETS = 16
AFTER_ALL_NAMES = "\U0010ffff"


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet folder under its schema; without the folder, no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def named(moment: datetime, form: str = MOMENT) -> str:
    return moment.astimezone(UTC).strftime(form)


@dataclass(frozen=True, order=True)
class Base:
    """A written state that counts from ``at`` on, with no row of a day after ``through``, in ``buckets`` folders.

    Of the runs before it, those merged after ``kept`` were rolled back.
    """

    at: datetime
    kept: datetime
    through: date
    buckets: int
    folder: str

    @classmethod
    def of(cls, folder: str) -> Base:
        at, kept, through, buckets = (part.split("=", 1)[1] for part in folder.rstrip("/").split("/")[-4:])
        at, kept = (datetime.strptime(moment, MOMENT).replace(tzinfo=UTC) for moment in (at, kept))
        return cls(at, kept, date.fromisoformat(through), int(buckets), folder)


class StateTable:
    """``schema`` are the fields of a row, ``scope`` is what a full snapshot covers, ``day`` orders the rows.

    Rows without a day, or of a table without that field, belong to the day of their merge.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType | None = None,
        key: str = "id",
        scope: str = "category_id",
        active: str = "is_active",
        day: str = "crawl_date",
        buckets: int = BUCKETS,
    ):
        self.spark, self.key, self.scope, self.active, self.day, self.buckets = spark, key, scope, active, day, buckets
        self.schema = schema or stored_schema()
        root = path.rstrip("/")
        self._runs, self._bases, self._covered = f"{root}/runs", f"{root}/bases", f"{root}/covered"

    # ---- writing

    def append(
        self, rows: DataFrame, run: str, at: datetime | None = None, snapshot: bool = False, may_be_repeated: bool = True
    ) -> None:
        """Add the rows of one load, one per key, merged at ``at``; ``snapshot`` says that they are all there are.

        A caller that knows a run to be new saves the search for an earlier one of its name.
        """
        at = at or datetime.now()
        earlier = existing_folders(self.spark, run_folder(f"{self._runs}/hour=*", run)) if may_be_repeated else []
        added = {"merged_at": F.lit(at), "snapshot": F.lit(snapshot)}
        hour = f"{self._runs}/hour={named(at, HOUR)}"
        append_run(rows.select(self.schema.fieldNames()).withColumns(added), hour, run)
        remove_folders(self.spark, [f for f in earlier if f"/hour={named(at, HOUR)}/" not in f])

    def write_base(
        self,
        state: DataFrame,
        at: datetime | None = None,
        covered: DataFrame | None = None,
        kept: datetime | None = None,
    ) -> None:
        """Make ``state`` the base of everything merged after ``at``.

        ``covered`` has (scope, _order): up to which place each scope is covered by full snapshots.
        Runs merged after ``kept`` do not count any more.
        """
        at = at or datetime.now()
        rows = state.select(self.schema.fieldNames())
        if covered is None:
            covered = self._with_order(self._read_runs([])).select(self.scope, "_order")
        covered = covered.groupBy(self.scope).agg(F.max("_order").alias("_order"))
        covered.select(self.scope, "_order.*").write.mode("overwrite").parquet(f"{self._covered}/at={named(at)}")
        last = rows.agg(F.max(self._day_of(F.lit(at)))).first()[0] or at.date()
        folder = f"{self._bases}/at={named(at)}/kept={named(kept or at)}/through={last}/buckets={self.buckets}"
        bucketed = rows.withColumn("bucket", self._bucket(self.buckets)).repartition("bucket")
        bucketed.sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy("bucket").parquet(folder)

    def renew_base(self, at: datetime) -> None:
        """Write the state as of ``at`` as a base: a time before any load that is still running."""
        rows, snapshots = self._ordered(at=at)
        if not rows.isEmpty():
            self.write_base(self._folded(rows, snapshots), at, snapshots)

    def rollback(self, to: datetime, at: datetime | None = None) -> None:
        """Make the state as of an earlier time the current one; later loads stay readable as of their times."""
        rows, snapshots = self._ordered(at=to)
        if rows.isEmpty():
            raise ValueError(f"there is no state as of {to}")
        self.write_base(self._folded(rows, snapshots), at, snapshots, to)

    def expire(self, keep: int) -> list[str]:
        """Remove all but the newest ``keep`` bases, and the hours of runs before the oldest of these.

        States as of that base or later read as before. Returns the folders that are gone.
        """
        if keep < 1:
            raise ValueError("one base has to stay")
        bases = self.bases()
        if len(bases) <= keep:
            return []
        oldest = bases[-keep].at
        gone = [f"{self._bases}/at={named(b.at)}" for b in bases[:-keep]]
        gone += [f"{self._covered}/at={named(b.at)}" for b in bases[:-keep]]
        gone += [f for f in self._hours() if f.rsplit("hour=", 1)[1] < named(oldest, HOUR)]
        remove_folders(self.spark, gone)
        return gone

    # ---- reading

    def bases(self) -> list[Base]:
        """The bases that were written to their end, oldest first."""
        whole = existing_folders(self.spark, f"{self._bases}/at=*/kept=*/through=*/buckets=*/_SUCCESS")
        return sorted(Base.of(f.rsplit("/", 1)[0]) for f in whole)

    def runs(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Loads merged after ``since`` and up to ``until``: their rows with merged_at, snapshot and run."""
        from_hour, to_hour = since and named(since, HOUR), until and named(until, HOUR)
        hours = [f for f in self._hours() if from_hour is None or f.rsplit("hour=", 1)[1] >= from_hour]
        hours = [f for f in hours if to_hour is None or f.rsplit("hour=", 1)[1] <= to_hour]
        rows = self._read_runs(hours)
        rows = rows if since is None else rows.filter(F.col("merged_at") > F.lit(since))
        return rows if until is None else rows.filter(F.col("merged_at") <= F.lit(until))

    def rows_of(self, run: str) -> DataFrame:
        """The rows that one run added."""
        folders = existing_folders(self.spark, run_folder(f"{self._runs}/hour=*", run))
        return self._read_runs(folders).select(self.schema.fieldNames())

    def is_empty(self) -> bool:
        return not self.bases() and self.runs().isEmpty()

    def newest_day(self, without: str | None = None) -> date | None:
        """The last day of any row, as if the run ``without`` had not happened."""
        bases = self.bases()
        base = bases[-1] if bases else None
        later = self._without_undone(self.runs(base and base.at), bases)
        if without is not None:
            later = later.filter(F.col("run") != without)
        found = later.agg(F.max(self._day_of(F.col("merged_at")))).first()[0]
        return max((d for d in (found, base and base.through) if d is not None), default=None)

    def read(
        self,
        at: datetime | None = None,
        without: str | None = None,
        keys: DataFrame | None = None,
        before: date | None = None,
    ) -> DataFrame:
        """The state now or as of a time, as if the run ``without`` had not happened.

        With ``before``, the state of all days before that day. With ``keys``, a column of key
        values, only their rows: the base is read in the buckets that the keys name, and a small
        set is sent to the table, so that none of its other rows are shuffled.
        """
        return self._folded(*self._ordered(at, without, keys, before))

    def ordered_rows(self, before: date | None = None, after: date | None = None) -> tuple[DataFrame, DataFrame]:
        """All kept rows of the days before or after a day, with their place ``_order``, and the snapshots among them.

        Of the days before, one row per key at least; of the days after, all rows of runs.
        """
        if after is None:
            return self._ordered(before=before)
        runs = self._without_undone(self.runs(), self.bases())
        late = F.col("_order.day") > F.lit(after)
        return self._with_order(runs).filter(late), self._snapshots(runs).filter(late)

    def log(self) -> DataFrame:
        """Runs with the time they were merged and their rows."""
        return self.runs().groupBy("run", "merged_at", "snapshot").agg(F.count(F.lit(1)).alias("row_count"))

    # ---- parts

    def _ordered(
        self,
        at: datetime | None = None,
        without: str | None = None,
        keys: DataFrame | None = None,
        before: date | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        """Rows with their place ``_order``, and (scope, _order) of the full snapshots."""
        bases = [b for b in self.bases() if at is None or b.at <= at.astimezone(UTC)]
        # a later base holds one row per key, so the rows of earlier days are not all in it
        base = next((b for b in reversed(bases) if before is None or b.through < before), None)
        later = self._without_undone(self.runs(base and base.at, at), bases)
        if without is not None:
            later = later.filter(F.col("run") != without)
        rows, snapshots = self._with_order(later), self._snapshots(later)
        if before is not None:
            early = F.col("_order.day") < F.lit(before)
            rows, snapshots = rows.filter(early), snapshots.filter(early)
        if base is not None:
            # behind all runs of its moment: what they cover is settled in the base's rows
            first = self._order(F.lit(base.at), F.lit(AFTER_ALL_NAMES))
            rows = self._read_base(base, keys).select(*self.schema.fieldNames(), first).unionByName(rows)
            place = F.struct("day", "merged_at", "run").alias("_order")
            covered = read_or_empty(self.spark, f"{self._covered}/at={named(base.at)}", self._cover_schema())
            snapshots = covered.select(self.scope, place).unionByName(snapshots)
        if keys is not None:
            rows = rows.join(keys.select(self.key), self.key, "left_semi").select(rows.columns)
        return rows, snapshots

    @staticmethod
    def _without_undone(runs: DataFrame, bases: list[Base]) -> DataFrame:
        for b in bases:
            if b.kept < b.at:
                runs = runs.filter(~F.col("merged_at").between(F.lit(b.kept), F.lit(b.at)) | (F.col("merged_at") == F.lit(b.kept)))
        return runs

    def _folded(self, rows: DataFrame, snapshots: DataFrame) -> DataFrame:
        state = replay_state(rows, self.key, "_order", self.scope, self.active, snapshots)
        return state.select(self.schema.fieldNames())

    def _with_order(self, runs: DataFrame) -> DataFrame:
        return runs.select(*self.schema.fieldNames(), self._order(F.col("merged_at"), F.col("run")))

    def _snapshots(self, runs: DataFrame) -> DataFrame:
        return runs.filter("snapshot").select(self.scope, self._order(F.col("merged_at"), F.col("run")))

    def _day_of(self, merged_at: Column) -> Column:
        merged_on = F.to_date(merged_at)
        return F.coalesce(F.col(self.day), merged_on) if self.day in self.schema.fieldNames() else merged_on

    def _order(self, merged_at: Column, run: Column) -> Column:
        return F.struct(
            self._day_of(merged_at).alias("day"), merged_at.alias("merged_at"), run.alias("run")
        ).alias("_order")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _read_base(self, base: Base, keys: DataFrame | None) -> DataFrame:
        rows = self.spark.read.schema(self._with(bucket="integer")).parquet(base.folder)
        if keys is None:
            return rows
        # one number per bucket at most
        asked = [r[0] for r in keys.select(self._bucket(base.buckets)).distinct().collect()]
        return rows.filter(F.col("bucket").isin(asked))

    def _hours(self) -> list[str]:
        return sorted(existing_folders(self.spark, f"{self._runs}/hour=*"))

    def _read_runs(self, folders: list[str]) -> DataFrame:
        fields = self._with(merged_at="timestamp", snapshot="boolean", hour="string", run="string")
        if not folders:
            return self.spark.createDataFrame([], fields).drop("hour")
        return self.spark.read.option("basePath", self._runs).schema(fields).parquet(*folders).drop("hour")

    def _cover_schema(self) -> StructType:
        scope = [f for f in self.schema.fields if f.name == self.scope]
        return StructType(scope).add("day", "date").add("merged_at", "timestamp").add("run", "string")

    def _with(self, **more: str) -> StructType:
        fields = StructType(list(self.schema.fields))
        for name, data_type in more.items():
            fields.add(name, data_type)
        return fields
