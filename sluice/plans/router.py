"""File routes, table filters and table routes: which file feeds which table."""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass

# The default file routes, in order (pattern, schema, table, type, key).
DEFAULT_ROUTES = [
    (r"(?i).*(-schema-trigger|-schema-post)\.sql$", "", "", "ignore", ""),
    (r"(?i)^(?:[^/]*/)*([^/.]+)-schema-create\.sql$", "$1", "", "schema-schema", ""),
    (r"(?i)^(?:[^/]*/)*([^/.]+)\.(.*?)-schema\.sql$", "$1", "$2", "table-schema", ""),
    (r"(?i)^(?:[^/]*/)*([^/.]+)\.(.*?)-schema-view\.sql$", "$1", "$2", "view-schema", ""),
    (r"(?i)^(?:[^/]*/)*([^/.]+)\.(.*?)(?:\.([0-9]+))?\.(sql|csv|parquet)$", "$1", "$2", "$4", "$3"),
]
# The default table filter.
DEFAULT_FILTER = ["*.*", "!mysql.*", "!sys.*", "!INFORMATION_SCHEMA.*", "!PERFORMANCE_SCHEMA.*", "!METRICS_SCHEMA.*", "!INSPECTION_SCHEMA.*"]
TYPES = ("ignore", "schema-schema", "table-schema", "view-schema", "sql", "csv", "parquet")
COMPRESSIONS = ("gz", "gzip", "lz4", "zstd", "xz")

_VARIABLE = re.compile(r"\$(?:(\$)|(\w+)|\{(\w+)\})")


@dataclass(frozen=True)
class Routed:
    schema: str
    table: str
    type: str
    key: str = ""


@dataclass
class Rule:
    """One file route.  Templates may hold $1, ${name} and $$; path instead of pattern matches one path exactly."""

    pattern: str
    schema: str = ""
    table: str = ""
    type: str = ""
    key: str = ""
    compression: str = ""

    def __post_init__(self) -> None:
        self._re = re.compile(re.sub(r"\(\?<(?![=!])", "(?P<", self.pattern))
        names = {*map(str, range(self._re.groups + 1)), *self._re.groupindex}
        for template in (self.schema, self.table, self.type, self.key, self.compression):
            for m in _VARIABLE.finditer(template):
                if not m[1] and (m[2] or m[3]) not in names:
                    raise ValueError(f"sub pattern {m[0]} is not a group of {self.pattern}")
        if not self.type:
            raise ValueError("a file route needs a type")

    def route(self, path: str) -> Routed | None:
        m = self._re.search(path)
        if not m:
            return None
        fill = lambda t: _VARIABLE.sub(lambda v: "$" if v[1] else (m[int(v[2] or v[3])] if (v[2] or v[3]).isdigit() else m[v[2] or v[3]]) or "", t)
        kind = fill(self.type).lower()
        if kind not in TYPES:
            raise ValueError(f"unknown file type {kind} of {path}")
        if (packed := fill(self.compression).lower()) and packed != "none":
            raise ValueError(f"compression {packed} of {path} is " + ("not supported" if packed in COMPRESSIONS else "unknown"))
        return Routed(fill(self.schema), fill(self.table), kind, fill(self.key))


class Router:
    """The first rule that matches decides; a file no rule matches, or an ignore rule does, is left out."""

    def __init__(self, rules: list[Rule] | None = None, defaults: bool = True):
        self.rules = [*(rules or []), *(Rule(*r) for r in DEFAULT_ROUTES if defaults)]

    def route(self, path: str) -> Routed | None:
        got = next((r for rule in self.rules if (r := rule.route(path))), None)
        return None if got is None or got.type == "ignore" else got


def _wild(pattern: str) -> str:
    return fnmatch.translate(pattern)


class TableFilter:
    """schema.table patterns with * and ?, and ! for exclusion; the last that matches decides."""

    def __init__(self, patterns: list[str] | None = None, case_sensitive: bool = False):
        self.flags = 0 if case_sensitive else re.I
        self.rules = []
        for p in patterns if patterns is not None else DEFAULT_FILTER:
            keep, p = not p.startswith("!"), p.lstrip("!")
            schema, dot, table = p.partition(".")
            if not dot:
                raise ValueError(f"not a schema.table pattern: {p}")
            self.rules.append((keep, re.compile(_wild(schema), self.flags), re.compile(_wild(table), self.flags)))

    def keeps(self, schema: str, table: str) -> bool:
        out = False
        for keep, s, t in self.rules:
            if s.match(schema) and t.match(table):
                out = keep
        return out


@dataclass
class TableRoute:
    """Merges tables: what fits both patterns goes to the target (an empty target table keeps its name)."""

    schema_pattern: str
    table_pattern: str = ""
    target_schema: str = ""
    target_table: str = ""

    def fits(self, schema: str, table: str) -> bool:
        both = re.compile(_wild(self.schema_pattern.lower())).match(schema.lower())
        return bool(both and (not self.table_pattern or re.compile(_wild(self.table_pattern.lower())).match(table.lower())))


def route_table(schema: str, table: str, routes: list[TableRoute]) -> tuple[str, str]:
    """Table-level routes win over schema-level ones; two of a level that fit are an error."""
    fitting = [r for r in routes if r.fits(schema, table)]
    level = [r for r in fitting if r.table_pattern] or fitting
    if len({(r.target_schema, r.target_table) for r in level}) > 1:
        raise ValueError(f"several routes fit {schema}.{table}")
    return (level[0].target_schema or schema, level[0].target_table or table) if level else (schema, table)
