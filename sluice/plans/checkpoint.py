"""Progress of loads that survives the driver: one small JSON file a table.

A new file is complete under the name ``.next`` before the old one goes; whoever reads or writes next finishes an exchange that a
lost driver left half done, so that there is a complete file at every moment.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The statuses, in order; a failed step is kept as its number divided by ten.
STATUS = {"missing": 0, "max_invalid": 25, "loaded": 30, "all_written": 60, "closed": 90, "imported": 120, "index_imported": 140, "altered_auto_inc": 150, "checksum_skipped": 170, "checksummed": 180, "analyze_skipped": 200, "analyzed": 210}
WHOLE_TABLE = 2147483647  # fixed value: the number that stands for the table itself among its batches
# The names under which statuses are counted.
_NAMES = {30: "pending", 60: "written", 90: "closed", 120: "imported", 140: "index_imported", 150: "altered_auto_inc", 170: "checksum", 180: "checksum", 200: "analyzed", 210: "analyzed", 0: "missing"}


def status_name(status: int) -> str:
    return _NAMES.get(status, "invalid")


@dataclass
class Chunk:
    path: str
    offset: int
    end: int
    row_base: int
    row_max: int
    pos: int = 0
    total_bytes: int = 0
    total_rows: int = 0
    checksum: int = 0


@dataclass
class Batch:
    status: int = STATUS["loaded"]
    chunks: list[Chunk] = field(default_factory=list)


@dataclass
class TableState:
    table: str
    hash: str  # of the table's definition and source, which must not change under a load
    task_time: str
    status: int = STATUS["loaded"]
    next_id: int = 0
    batches: dict[int, Batch] = field(default_factory=dict)
    task: dict = field(default_factory=dict)

    def fail(self, batch: int | None = None) -> None:
        """Marks the table, and the batch, as failed in the step they were in."""
        self.status //= 10
        if batch is not None:
            self.batches[batch].status //= 10

    def advance(self, status: str, batch: int | None = None) -> None:
        if batch is None:
            self.status = max(self.status, STATUS[status])
        else:
            self.batches[batch].status = max(self.batches[batch].status, STATUS[status])

    def rebase(self, next_id: int) -> None:
        self.next_id = max(self.next_id, next_id)


def _read(d: dict) -> TableState:
    batches = {int(k): Batch(b["status"], [Chunk(**c) for c in b["chunks"]]) for k, b in d.pop("batches").items()}
    return TableState(**d, batches=batches)


class Store:
    """Checkpoints in a folder of any Hadoop file system.  With root None nothing is kept."""

    def __init__(self, spark: SparkSession, root: str | None):
        self.spark, self.root = spark, root.rstrip("/") if root else None

    def _fs(self):  # noqa: ANN202
        jvm = self.spark._jvm
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _file(self, table: str) -> str:
        return f"{self.root}/{table.replace('/', '%2F')}.json"

    def tables(self) -> list[str]:
        if not self.root:
            return []
        fs, path = self._fs()
        if not fs.exists(path(self.root)):
            return []
        names = {f.getPath().getName().removesuffix(".next") for f in fs.listStatus(path(self.root))}
        return sorted(n.removesuffix(".json").replace("%2F", "/") for n in names if n.endswith(".json"))

    def _settle(self, table: str) -> None:
        """Puts the complete new file in the place of the old one, if there is one."""
        fs, path = self._fs()
        final, new = path(self._file(table)), path(self._file(table) + ".next")
        if fs.exists(new):
            fs.delete(final, False)
            if not fs.rename(new, final):
                raise OSError(f"could not replace {final.toString()}")

    def get(self, table: str) -> TableState | None:
        if not self.root:
            return None
        self._settle(table)
        fs, path = self._fs()
        if not fs.exists(path(self._file(table))):
            return None
        stream = fs.open(path(self._file(table)))
        try:
            return _read(json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()))
        finally:
            stream.close()

    def put(self, state: TableState) -> None:
        if not self.root:
            return
        self._settle(state.table)
        fs, path = self._fs()
        part = path(self._file(state.table) + ".part")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(asdict(state)).encode()))
        out.close()
        if not fs.rename(part, path(self._file(state.table) + ".next")):
            raise OSError(f"could not store the checkpoint of {state.table}")
        self._settle(state.table)

    def init(self, state: TableState) -> TableState:
        """The stored state, or this one stored; a stored one of another definition is refused."""
        old = self.get(state.table)
        if old is None:
            self.put(state)
            return state
        if old.hash != state.hash:
            raise ValueError(f"checkpoint of {state.table} belongs to another definition or source; remove it first")
        return old

    def remove(self, table: str = "all") -> None:
        for t in self.tables() if table == "all" else [table]:
            fs, path = self._fs()
            for end in (".part", ".next", ""):
                fs.delete(path(self._file(t) + end), False)

    def move(self, task: str) -> None:
        """Puts all checkpoints aside under the task's name."""
        if self.root:
            fs, path = self._fs()
            fs.rename(path(self.root), path(f"{self.root}.{task}.bak"))

    def ignore_error(self, table: str = "all") -> None:
        for t in self.tables() if table == "all" else [table]:
            state = self.get(t)
            if state is None:
                continue
            for x in (state, *state.batches.values()):
                if x.status <= STATUS["max_invalid"]:
                    x.status = STATUS["loaded"]
            self.put(state)

    def destroy_error(self, table: str = "all") -> list[tuple[str, int, int]]:
        """(table, smallest, largest batch) of failed tables, whose checkpoints go; the caller drops their data."""
        rows = destroyed(*self.frames()[:2]).collect() if self.tables() else []
        out = [(r.table_name, r.min_batch, r.max_batch) for r in rows if table in ("all", r.table_name)]
        for name, *_ in out:
            self.remove(name)
        return out

    def frames(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The checkpoints as tables: (tables, batches, chunks)."""
        states = [s for t in self.tables() if (s := self.get(t))]
        tables = [(s.table, s.hash, s.status, s.next_id) for s in states]
        batches = [(s.table, k, b.status) for s in states for k, b in s.batches.items()]
        chunks = [(s.table, k, c.path, c.offset, c.end, c.pos, c.row_base, c.row_max, c.total_bytes, c.total_rows, c.checksum) for s in states for k, b in s.batches.items() for c in b.chunks]
        make = self.spark.createDataFrame
        return (
            make(tables, "table_name string, hash string, status int, next_id long"),
            make(batches, "table_name string, batch_id int, status int"),
            make(chunks, "table_name string, batch_id int, path string, offset long, end_offset long, pos long, row_base long, row_max long, total_bytes long, total_rows long, checksum long"),
        )

    def dump(self, folder: str) -> None:
        for name, df, order in zip(("tables", "batches", "chunks"), self.frames(), (["table_name"], ["table_name", "batch_id"], ["table_name", "batch_id", "path", "offset"])):
            df.coalesce(1).orderBy(*order).write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def local_tables(tables: DataFrame, batches: DataFrame, chunks: DataFrame) -> DataFrame:
    """(table_name, batch_id) with data under way: a chunk begun, and a batch neither finished nor untouched."""
    t = tables.where(f"status > {STATUS['max_invalid']} and status < {STATUS['index_imported']}").select("table_name")
    b = batches.where(f"status > {STATUS['max_invalid']} and status < {STATUS['imported']}").select("table_name", "batch_id")
    return t.join(b, "table_name").join(chunks.where("pos > offset").select("table_name", "batch_id"), ["table_name", "batch_id"]).select("table_name", "batch_id").distinct()


def destroyed(tables: DataFrame, batches: DataFrame) -> DataFrame:
    """(table_name, min_batch, max_batch) of failed tables; 0 and -1 where a table has no batch."""
    failed = tables.where(f"status <= {STATUS['max_invalid']}").select("table_name")
    joined = failed.join(batches.select("table_name", "batch_id"), "table_name", "left")
    return joined.groupBy("table_name").agg(F.coalesce(F.min("batch_id"), F.lit(0)).alias("min_batch"), F.coalesce(F.max("batch_id"), F.lit(-1)).alias("max_batch"))


def pending(batches: DataFrame, upto: str = "imported") -> DataFrame:
    return batches.where(f"status < {STATUS[upto]}")


def ignored(tables: DataFrame) -> DataFrame:
    return tables.withColumn("status", F.when(F.col("status") <= STATUS["max_invalid"], STATUS["loaded"]).otherwise(F.col("status")))
