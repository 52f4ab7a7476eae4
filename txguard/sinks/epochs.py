"""Tables of epochs under a commit log: replays swap atomically, compaction touches new epochs only.

    <path>/data/epoch_id=<n>/try=<id>/      rows of one try to write an epoch
    <path>/log/after=<v>/epoch_id=<n>/...   one line per try, written after its rows: the newest one counts
    <path>/merged/gen=<id>/                 rows of many epochs, by partition columns, in large files
    <path>/state/version=<v>/               one line: merged up to which epoch, and the generations that hold it

What is not named by the newest state or its log does not exist for readers, so a crash at any point leaves the table as it
was before or after the step, and no folder is ever overwritten or deleted while it is read. `State.replaced` names
what a version has made superfluous, for the store's own retention.

There is one writer, as a streaming query is; readers are free. A table may be `additive`: `merge` then adds up rows with equal keys
(sums, sketches), when epochs are merged and when the table is read.
"""

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame], DataFrame]

_GENERATION = "struct<id: string, level: int, first: bigint, last: bigint>"
_STATE = f"through bigint, generations array<{_GENERATION}>, replaced array<string>, version bigint"
_LOG = "epoch bigint, attempt string, at bigint"


@dataclass(frozen=True)
class Generation:
    id: str
    level: int
    first: int
    last: int


@dataclass(frozen=True)
class State:
    version: int = 0
    through: int = -1
    generations: tuple[Generation, ...] = ()
    replaced: tuple[str, ...] = ()


def _lines(spark: SparkSession, path: str, ddl: str) -> list:
    """Rows of small JSON files; none where there is no folder yet."""
    try:
        return spark.read.schema(ddl).json(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


class EpochTable:
    """partitions: columns of the folders of merged rows. fan: so many generations of one level become one of the next, so that
    there are few of them, and a row is written again log(epochs) times at most."""

    def __init__(
        self, spark: SparkSession, path: str, partitions: tuple[str, ...] = (), merge: Merge | None = None, fan: int = 8
    ):
        self.spark, self.path, self.partitions, self.merge, self.fan = spark, path.rstrip("/"), partitions, merge, fan
        self._state: State | None = None

    # --- State and log ---------------------------------------------------------------------------------------

    def state(self) -> State:
        """The newest state in the store."""
        found = _lines(self.spark, f"{self.path}/state", _STATE)
        if not found:
            return State()
        r = max(found, key=lambda r: r.version)
        made = tuple(Generation(g.id, g.level, g.first, g.last) for g in r.generations)
        return State(r.version, r.through, made, tuple(r.replaced))

    def _known(self) -> State:
        """The state as its one writer knows it."""
        if self._state is None:
            self._state = self.state()
        return self._state

    def _swap(self, state: State) -> None:
        row = {"through": state.through, "generations": [asdict(g) for g in state.generations], "replaced": list(state.replaced)}
        self._put(row, f"state/version={state.version}")
        self._state = state

    def _log(self, version: int, epoch: int, attempt: str, at: int) -> None:
        self._put({"epoch": epoch, "attempt": attempt, "at": at}, f"log/after={version}/epoch_id={epoch}/try={attempt}")

    def _put(self, row: dict, folder: str) -> None:
        """One line in one file, which appears as a whole."""
        line = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(row)))
        line.write.mode("overwrite").text(f"{self.path}/{folder}")

    def _entries(self, state: State) -> dict:
        """The line that counts of each epoch that is not merged yet."""
        newest: dict = {}
        for r in _lines(self.spark, f"{self.path}/log/after={state.version}", _LOG):
            if r.epoch > state.through and (r.epoch not in newest or r.at > newest[r.epoch].at):
                newest[r.epoch] = r
        return newest

    # --- Writing ---------------------------------------------------------------------------------------------

    def write(self, df: DataFrame, epoch_id: int) -> None:
        """The rows of one epoch instead of those of an earlier try. An epoch without rows may be written too. Epochs that were
        merged before cannot be written again: a streaming query repeats its last epoch only."""
        if epoch_id <= self._known().through:
            raise ValueError(f"epoch {epoch_id} is merged up to {self._known().through}")
        attempt = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/epoch_id={epoch_id}/try={attempt}")
        self._log(self._known().version, epoch_id, attempt, time.time_ns())

    def compact(self, before: int) -> State:
        """Merges the epochs below `before` that are not merged yet into a new generation; earlier ones are not read, except
        where `fan` generations of a level have come together."""
        state = self._known()
        entries = self._entries(state)
        closed = sorted(e for e in entries if e < before)
        if not closed:
            return state
        made = self._merged(self._epochs([entries[e] for e in closed]), Generation(uuid.uuid4().hex, 0, closed[0], closed[-1]))
        generations, replaced = [*state.generations, made], [f"data/epoch_id={e}" for e in closed]
        while len(tail := generations[-self.fan :]) == self.fan and len({g.level for g in tail}) == 1:
            whole = Generation(uuid.uuid4().hex, tail[0].level + 1, tail[0].first, tail[-1].last)
            generations[-self.fan :] = [self._merged(self._generations(tail), whole)]
            replaced += [f"merged/gen={g.id}" for g in tail]
        for e in entries.values():
            if e.epoch >= before:
                self._log(state.version + 1, e.epoch, e.attempt, e.at)
        self._swap(State(state.version + 1, closed[-1], tuple(generations), tuple(replaced)))
        return self._known()

    def _merged(self, rows: DataFrame, as_: Generation) -> Generation:
        """REBALANCE groups rows by partition value, and cuts large values into several files."""
        rows = self.merge(rows) if self.merge else rows
        rows = rows.hint("rebalance", *[F.col(c) for c in self.partitions])
        writer = rows.write.partitionBy(*self.partitions) if self.partitions else rows.write
        writer.parquet(f"{self.path}/merged/gen={as_.id}")
        return as_

    # --- Reading ---------------------------------------------------------------------------------------------

    def _epochs(self, entries: list) -> DataFrame:
        folders = [f"{self.path}/data/epoch_id={e.epoch}/try={e.attempt}" for e in entries]
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders)
        rows = rows.drop("try")
        return rows.drop("epoch_id") if self.merge else rows.withColumn("epoch_id", F.col("epoch_id").cast("bigint"))

    def _generations(self, generations: list[Generation]) -> DataFrame:
        folders = [f"{self.path}/merged/gen={g.id}" for g in generations]
        return self.spark.read.option("basePath", f"{self.path}/merged").parquet(*folders).drop("gen")

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows, each once, with `epoch_id` (merged, without it, if the table is additive); None if nothing was written.
        before: epochs below that one, which must not be merged yet."""
        state = self.state()
        if before is not None and state.through >= before:
            raise ValueError(f"epochs are merged up to {state.through}")
        entries = [e for n, e in sorted(self._entries(state).items()) if before is None or n < before]
        parts = []
        if state.generations:
            parts.append(self._generations(list(state.generations)))
        if entries:
            parts.append(self._epochs(entries))
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        return self.merge(rows) if self.merge else rows

    def register(self, name: str) -> None:
        """A view over the merged rows, for ad-hoc SQL: as many branches as generations, however many epochs there were. It is
        replaced in one step; call it again after `compact`."""
        generations = self.state().generations
        if not generations:
            raise ValueError("nothing is merged yet")
        columns = ", ".join(f"`{c}`" for c in self._generations(list(generations)).columns)
        parts = [f"SELECT {columns} FROM parquet.`{self.path}/merged/gen={g.id}`" for g in generations]
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")


def into(table: EpochTable, make: Merge = lambda df: df, compact_every: int | None = None):
    """A sink for `streaming.runner`: writes `make(rows)` of each epoch, and merges the epochs before every so many."""

    def sink(df: DataFrame, epoch_id: int) -> None:
        table.write(make(df), epoch_id)
        if compact_every and epoch_id and epoch_id % compact_every == 0:
            table.compact(before=epoch_id)

    return sink
