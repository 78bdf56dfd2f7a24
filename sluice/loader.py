"""A load from end to end: discover, read, encode, stage in batches, resolve duplicates, sort, commit, verify.

A table goes through staged batches (each written by one Spark job and committed by a rename, so that a resumed load skips it) and one
import job that resolves duplicate keys over the whole table, sorts by key range and puts the result in place.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .logs import log, retried
from .operators import checksum, duplicates, encode, ranges
from .plans import checkpoint as cp
from .plans import ddl, regions
from .plans.router import Router, TableFilter
from .sources import catalog, dumps, manifest
from .sources.parse import CsvParser


class Loader:
    """One task.  spark is handed in, so that the engine can be embedded."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config.check()
        self.store = cp.Store(spark, self.config.checkpoint.dir if self.config.checkpoint.enable else None)
        self.progress: dict[str, dict] = {}
        self.errors: dict[str, str] = {}
        self.gate = threading.Event()
        self.gate.set()
        self.stopped = threading.Event()

    # control
    def pause(self) -> None:
        self.gate.clear()

    def resume(self) -> None:
        self.gate.set()

    def stop(self) -> None:
        self.stopped.set()
        self.gate.set()

    def _pass_gate(self) -> None:
        self.gate.wait()
        if self.stopped.is_set():
            raise InterruptedError("the task was stopped")

    # file system
    def _fs(self):  # noqa: ANN202
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.config.target.dir).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _bytes(self, path: str) -> bytes:
        return bytes(self.spark.read.format("binaryFile").load(path).select("content").first()[0])

    def _commit(self, staged: str, final: str) -> None:
        retried(lambda: self._move(staged, final))

    def _move(self, staged: str, final: str) -> None:
        """staged in the place of final, which is put aside until then and comes back if the move fails."""
        fs, path = self._fs()
        new, old, aside = path(staged), path(final), path(f"{staged}.old")
        fs.mkdirs(old.getParent())
        if fs.exists(old) and not fs.rename(old, aside):
            raise OSError(f"could not put {final} aside")
        moved = False
        try:
            moved = fs.rename(new, old)
        finally:
            if not moved and fs.exists(aside):
                fs.rename(aside, old)
        if not moved:
            raise OSError(f"could not move {staged} to {final}")
        fs.delete(aside, True)

    def table_path(self, table: manifest.SourceTable) -> str:
        return f"{self.config.target.dir.rstrip('/')}/{table.schema}/{table.name}"

    # steps
    def discover(self) -> manifest.Manifest:
        c = self.config.source
        files = manifest.list_files(self.spark, c.data_source_dir)
        return manifest.build(files, Router(self.config.rules(), c.default_file_rules), TableFilter(c.filter, c.case_sensitive), self.config.table_routes(), c.no_schema)

    def table_spec(self, table: manifest.SourceTable) -> ddl.TableSpec:
        if table.schema_file is None:
            kind = self.spark.read.parquet(self.table_path(table)).dtypes  # the table is there already
            return ddl.TableSpec(table.name, [catalog.from_spark(t, n) for n, t in kind if n != encode.ROW_ID])
        return ddl.parse_create_table(ddl.decode(self._bytes(table.schema_file.path), self.config.source.character_set))

    def plan(self, table: manifest.SourceTable, spec: ddl.TableSpec) -> list[regions.Region]:
        """One region a file: Spark splits strict-format CSV and Parquet by itself."""
        c, out = self.config.source, []
        for f in table.files:
            size = self.spark.read.parquet(f.path).count() if f.routed.type == "parquet" else f.size
            out.append(regions.file_regions(f.path, f.routed.type, size, len(spec.columns), None, c.max_region_size))
            if f.routed.type == "csv" and c.strict_format:  # row ids are byte places
                out[-1] = [replace(out[-1][0], row_max=f.size + 1)]
        return regions.with_batches(regions.table_regions(out), size=c.batch_size, ratio=c.batch_import_ratio, most=self.config.app.table_concurrency)

    def scan(self, spec: ddl.TableSpec, part: list[regions.Region], task_time: str) -> DataFrame:
        """The encoded rows of some regions."""
        c, frames = self.config.source, []
        binary = {x.name.lower() for x in spec.columns if x.family() == "binary"}
        for kind in dict.fromkeys(r.kind for r in part):
            own = [r for r in part if r.kind == kind]
            paths, bases = [r.path for r in own], {r.path: r.row_base for r in own}
            settings = {"strict": self.config.strict, "task_time": task_time, "chunk": None}
            if kind == "parquet":
                df = dumps.read_parquet(self.spark, paths, bases).drop("path")
                frames.append(encode.encode(df, spec, source_columns=[x for x in df.columns if x != encode.ROW_ID], **settings))
                continue
            if kind == "csv" and c.strict_format:
                parsed = dumps.read_lines(self.spark, paths, bases, c.csv.dialect())
            else:
                parsed = dumps.read_whole(self.spark, paths, kind, bases, c.csv.dialect(), self.config.backslash_escapes)
            for names in self._column_lists(kind, own, parsed):
                same = parsed.where(F.col("columns").eqNullSafe(F.array(*[F.lit(n) for n in names]) if names is not None else F.lit(None).cast("array<string>")))
                most = len(spec.columns)
                wide = same.withColumn("fields", F.when(F.size("fields") > len(names or spec.columns), F.raise_error(F.concat(F.lit("column count mismatch in "), "path")).cast("array<binary>")).otherwise(F.col("fields")))
                wide = dumps.named(wide, names or [x.name.lower() for x in spec.columns][:most], binary)
                frames.append(encode.encode(wide, spec, source_columns=names, **settings))
        return reduce(DataFrame.unionByName, frames)

    def _column_lists(self, kind: str, part: list[regions.Region], parsed: DataFrame) -> list[list[str] | None]:
        """The different column lists of the files: few, and found without parsing rows where a header holds them."""
        c = self.config.source.csv
        if kind == "csv" and not c.header:
            return [None]
        if kind == "csv":
            lists = {tuple(CsvParser(c.dialect()).header(first.value.encode())[1]) for r in part if (first := self.spark.read.text(r.path).limit(1).first())}
            return [list(x) for x in sorted(lists)]
        rows = parsed.select("columns").distinct().collect()
        return sorted((r[0] for r in rows), key=lambda x: (x is not None, x or []))

    def restore_table(self, table: manifest.SourceTable) -> dict:
        name = f"`{table.schema}`.`{table.name}`"
        spec = self.table_spec(table)
        planned = self.plan(table, spec) if table.files else []
        digest = hashlib.sha256(repr((spec, [(f.path, f.size) for f in table.files])).encode()).hexdigest()
        state = cp.TableState(name, digest, time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime()))
        for r in planned:
            batch = state.batches.setdefault(r.batch, cp.Batch())
            batch.chunks.append(cp.Chunk(r.path, r.offset, r.end, r.row_base, r.row_max))
        state = self.store.init(state)
        if state.status <= cp.STATUS["max_invalid"] or any(b.status <= cp.STATUS["max_invalid"] for b in state.batches.values()):
            raise ValueError(f"the last load of {name} failed; use checkpoint-error-ignore, -destroy or -remove on it first")
        told = self.progress[name] = {"total": table.size, "written": 0, "status": cp.status_name(state.status)}
        if state.status >= cp.STATUS["imported"]:
            told |= {"written": table.size, "status": "imported"}
            return {"table": name, "skipped": True}
        staging, current = f"{self.config.target.dir.rstrip('/')}/_staging/{table.schema}.{table.name}", None
        fs, path = self._fs()
        for k, batch in state.batches.items():  # a staged batch that is gone is staged again
            if cp.STATUS["closed"] <= batch.status < cp.STATUS["imported"] and not fs.exists(path(f"{staging}/batch={k}")):
                batch.status = cp.STATUS["loaded"]
        try:
            for current in sorted(state.batches):
                self._pass_gate()
                batch, own = state.batches[current], [r for r in planned if r.batch == current]
                if batch.status < cp.STATUS["closed"]:
                    part = f"{staging}/.part-{uuid.uuid4().hex}"
                    self.scan(spec, own, state.task_time).write.parquet(part)
                    self._commit(part, f"{staging}/batch={current}")
                    for c in batch.chunks:
                        c.pos = c.end
                    state.advance("closed", current)
                    self.store.put(state)
                told["written"] += sum(r.size for r in own)
            current = None
            result = self._import(table, spec, state, staging)
            told["status"] = cp.status_name(state.status)
            return result
        except InterruptedError:
            raise
        except Exception:
            state.fail(current)
            self.store.put(state)
            raise

    def _import(self, table: manifest.SourceTable, spec: ddl.TableSpec, state: cp.TableState, staging: str) -> dict:
        final = self.table_path(table)
        columns = [c.name for c in spec.columns]
        if state.batches:
            rows = self.spark.read.parquet(*[f"{staging}/batch={k}" for k in sorted(state.batches)])
        else:
            rows = self.spark.createDataFrame([], spec.schema()).withColumn(encode.ROW_ID, F.lit(0).cast("long"))
        ids = encode.next_ids(rows, spec).first()
        rows = duplicates.resolve_all(rows, [spec.primary_key, *spec.uniques], self.config.target.on_duplicate)
        rows = ranges.range_sorted(rows, spec.primary_key or [encode.ROW_ID]).select(*([] if not spec.implicit_row_id() else [encode.ROW_ID]), *[f"`{c}`" for c in columns])
        part = f"{staging}/.import-{uuid.uuid4().hex}"
        rows.write.parquet(part)
        self._commit(part, final)
        for k in state.batches:
            state.advance("imported", k)
        state.advance("imported")
        state.rebase(1 + max([0, *(int(v) for v in ids if v is not None)]))
        state.advance("altered_auto_inc")
        self.store.put(state)
        return {"table": name_of(table), "rows": self._verify(final, rows, columns, state), "next_id": state.next_id}

    def _verify(self, final: str, rows: DataFrame, columns: list[str], state: cp.TableState) -> int:
        """Checksum of what was computed against what the files hold, then statistics; each off, optional or required."""
        level = self.config.post_restore
        stored = self.spark.read.parquet(final)
        if level.checksum == "off":
            state.advance("checksum_skipped")
        else:
            try:
                checksum.compare(checksum.checksum(stored, columns), checksum.checksum(rows, columns))
                state.advance("checksummed")
            except ValueError:
                if level.checksum == "required":
                    raise
                state.advance("checksum_skipped")
        if level.analyze == "off":
            state.advance("analyze_skipped")
        else:
            kinds = dict(stored.dtypes)
            checksum.statistics(stored, [c for c in columns if kinds[c] != "binary"] or columns[:0]).write.mode("overwrite").parquet(f"{self.config.target.dir.rstrip('/')}/_statistics/{state.table.replace('`', '')}")
            state.advance("analyzed")
        self.store.put(state)
        return stored.count()

    def run_once(self) -> list[dict]:
        """Loads every table; several at a time.  Errors are collected by table and raised together at the end."""
        found = self.discover()
        with ThreadPoolExecutor(self.config.app.table_concurrency) as pool:
            jobs = [(name_of(t), pool.submit(self.restore_table, t)) for t in found.tables]
            out = []
            for name, job in jobs:
                try:
                    out.append(job.result())
                except Exception as e:  # noqa: BLE001
                    self.errors[name] = str(e)
                    log.error("table %s failed: %s", name, e)
        for view in found.views:
            try:
                self._view(view)
            except Exception as e:  # noqa: BLE001
                self.errors[name_of(view)] = str(e)
        if self.errors:
            raise RuntimeError("; ".join(f"{t}: {e.splitlines()[0]}" for t, e in sorted(self.errors.items())))
        fs, path = self._fs()
        fs.delete(path(f"{self.config.target.dir.rstrip('/')}/_staging"), True)
        if self.config.checkpoint.enable:
            if self.config.checkpoint.keep_after_success:
                self.store.move(self.config.task_id or uuid.uuid4().hex)
            else:
                self.store.remove("all")
        return out

    def _view(self, view: manifest.SourceTable) -> None:
        """A view file's SELECT as a temporary view over the loaded tables."""
        text = ddl.decode(self._bytes(view.schema_file.path), self.config.source.character_set)
        at = text.upper().rfind(" AS ")
        body = text[at + 4 :].strip().rstrip(";")
        for t in self.discover().tables:
            if t.schema == view.schema:
                self.spark.read.parquet(self.table_path(t)).createOrReplaceTempView(t.name)
        body = body.replace(f"`{view.schema}`.", "").replace(f"{view.schema}.", "")
        self.spark.sql(body).createOrReplaceTempView(view.name)

    def destroy_error(self, table: str = "all") -> list[tuple[str, int, int]]:
        out = self.store.destroy_error(table)
        fs, path = self._fs()
        for name, *_ in out:
            schema, _, base = name.replace("`", "").partition(".")
            fs.delete(path(f"{self.config.target.dir.rstrip('/')}/{schema}/{base}"), True)
            fs.delete(path(f"{self.config.target.dir.rstrip('/')}/_staging/{schema}.{base}"), True)
        return out

    def status(self) -> dict:
        """Written bytes weigh 0.8 and imports 0.2 of a table's progress."""
        weight = lambda t: 0.8 * t["written"] / max(1, t["total"]) + (0.2 if t["status"] not in ("pending", "written", "closed", "missing") else 0)
        return {"tables": {k: t | {"progress": round(weight(t), 4)} for k, t in self.progress.items()}, "errors": dict(self.errors), "paused": not self.gate.is_set()}


def name_of(table: manifest.SourceTable) -> str:
    return f"`{table.schema}`.`{table.name}`"
