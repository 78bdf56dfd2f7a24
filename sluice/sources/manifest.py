"""What a source folder holds: its files, routed, filtered, checked, and put together as tables in loading order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..plans.router import Routed, Router, TableFilter, TableRoute, route_table


@dataclass
class SourceFile:
    path: str
    size: int
    routed: Routed


@dataclass
class SourceTable:
    schema: str
    name: str
    schema_file: SourceFile | None = None
    files: list[SourceFile] = field(default_factory=list)

    @property
    def size(self) -> int:
        return sum(f.size for f in self.files)


@dataclass
class Manifest:
    schemas: dict[str, SourceFile | None] = field(default_factory=dict)
    tables: list[SourceTable] = field(default_factory=list)
    views: list[SourceTable] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t.schema, t.name, f.path, f.routed.type, f.routed.key, f.size) for t in self.tables for f in t.files]
        return spark.createDataFrame(rows, "schema string, table string, path string, type string, key string, size long")


def list_files(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    """(path, path below root, bytes) of all files below root, in order of their path."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.makeQualified(base).toString().rstrip("/") + "/"
    out, it = [], fs.listFiles(base, True)
    while it.hasNext():
        f = it.next()
        full = f.getPath().toString()
        out.append((full, full.removeprefix(top), f.getLen()))
    return sorted(out)


def build(files: list[tuple[str, str, int]], router: Router | None = None, tables: TableFilter | None = None, routes: list[TableRoute] | None = None, no_schema: bool = False) -> Manifest:
    """Routes the files and checks that they fit together.  Tables come by size, files by key and then path."""
    router, keep = router or Router(), tables or TableFilter()
    out, found, views = Manifest(), {}, {}
    for path, below, size in files:
        got = router.route(below)
        if got is None:
            continue
        if got.type == "schema-schema":
            if keep.keeps(got.schema, ""):
                if out.schemas.get(got.schema):
                    raise ValueError(f"database {got.schema} has two schema files, {path} is the second")
                out.schemas[got.schema] = SourceFile(path, size, got)
            continue
        if not keep.keeps(got.schema, got.table):
            continue
        where = route_table(got.schema, got.table, routes or [])
        pool = views if got.type == "view-schema" else found
        table = pool.setdefault(where, SourceTable(*where))
        if got.type.endswith("-schema"):
            if table.schema_file and where == (got.schema, got.table):
                raise ValueError(f"table {'.'.join(where)} has two schema files, {path} is the second")
            table.schema_file = table.schema_file or SourceFile(path, size, got)
        else:
            table.files.append(SourceFile(path, size, got))
        out.schemas.setdefault(where[0], None)
    if not no_schema:
        for (schema, name), table in found.items():
            if table.schema_file is None:
                raise ValueError(f"missing {{schema}}.{{table}}-schema.sql for {schema}.{name}")
            if out.schemas.get(schema) is None and not routes:
                raise ValueError(f"missing {schema}-schema-create.sql")
    for where in views:
        if where not in found and not no_schema:
            raise ValueError(f"view {'.'.join(where)} has no table schema file")
    if routes:
        left = {t[0] for t in found}
        out.schemas = {s: f for s, f in out.schemas.items() if s in left}
    for table in found.values():
        table.files.sort(key=lambda f: (f.routed.key, f.path))
    out.tables = sorted((t for k, t in found.items() if k not in views), key=lambda t: (t.size, t.schema, t.name))
    out.views = [views[k] for k in sorted(views)]
    return out
