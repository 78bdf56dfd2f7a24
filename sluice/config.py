"""Settings of a load: defaults, a TOML file, command-line flags, checks."""

from __future__ import annotations

import argparse
import tomllib
from dataclasses import dataclass, field, fields, is_dataclass

from .operators.duplicates import POLICIES
from .plans.router import DEFAULT_FILTER, Rule, TableRoute
from .sources.parse import Dialect

LEVELS = ("off", "optional", "required")


@dataclass
class Csv:
    separator: str = ","
    delimiter: str = '"'
    header: bool = True
    not_null: bool = False
    null: str = "\\N"
    backslash_escape: bool = True
    trim_last_separator: bool = False

    def dialect(self) -> Dialect:
        return Dialect(**{f.name: getattr(self, f.name) for f in fields(self)})


@dataclass
class Source:
    data_source_dir: str = ""
    filter: list[str] = field(default_factory=lambda: list(DEFAULT_FILTER))
    case_sensitive: bool = False
    no_schema: bool = False
    character_set: str = "auto"
    strict_format: bool = False
    max_region_size: int = 256 << 20
    batch_size: int = 100 << 30
    batch_import_ratio: float = 0.75
    default_file_rules: bool = True
    files: list[dict] = field(default_factory=list)
    csv: Csv = field(default_factory=Csv)


@dataclass
class Target:
    dir: str = ""
    sql_mode: str = "ONLY_FULL_GROUP_BY,NO_AUTO_CREATE_USER"
    on_duplicate: str = "replace"


@dataclass
class Checkpoint:
    enable: bool = True
    dir: str = ""
    keep_after_success: bool = False


@dataclass
class PostRestore:
    checksum: str = "required"
    analyze: str = "optional"


@dataclass
class App:
    table_concurrency: int = 4


@dataclass
class Config:
    source: Source = field(default_factory=Source)
    target: Target = field(default_factory=Target)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)
    post_restore: PostRestore = field(default_factory=PostRestore)
    app: App = field(default_factory=App)
    routes: list[dict] = field(default_factory=list)
    task_id: str = ""

    @property
    def strict(self) -> bool:
        modes = {m.strip().upper() for m in self.target.sql_mode.split(",")}
        return bool(modes & {"STRICT_TRANS_TABLES", "STRICT_ALL_TABLES", "TRADITIONAL"})

    @property
    def backslash_escapes(self) -> bool:
        return "NO_BACKSLASH_ESCAPES" not in self.target.sql_mode.upper()

    def rules(self) -> list[Rule]:
        return [Rule(**r) for r in self.source.files]

    def table_routes(self) -> list[TableRoute]:
        return [TableRoute(**r) for r in self.routes]

    def check(self) -> Config:
        self.source.csv.dialect()
        self.rules()
        self.target.on_duplicate = self.target.on_duplicate.lower()
        if self.target.on_duplicate not in POLICIES:
            raise ValueError(f"on_duplicate must be one of {POLICIES}, not {self.target.on_duplicate}")
        for name in ("checksum", "analyze"):
            level = getattr(self.post_restore, name)
            level = {True: "required", False: "off"}.get(level, level)
            if level not in LEVELS:
                raise ValueError(f"{name} must be one of {LEVELS}, not {level}")
            setattr(self.post_restore, name, level)
        if not self.source.data_source_dir or not self.target.dir:
            raise ValueError("source.data_source_dir and target.dir must be set")
        if not 0 <= self.source.batch_import_ratio < 1:
            raise ValueError("batch_import_ratio must be in [0, 1)")
        if self.source.strict_format and self.source.csv.delimiter and "\n" in self.source.csv.separator:
            raise ValueError("strict_format needs separators without line ends")
        self.checkpoint.dir = self.checkpoint.dir or f"{self.target.dir.rstrip('/')}/_checkpoints"
        return self


def _fill(target: object, values: dict, where: str = "") -> None:
    known = {f.name for f in fields(target)}
    for key, value in values.items():
        name = key.replace("-", "_")
        if name not in known:
            raise ValueError(f"unknown configuration key {where}{key}")
        inner = getattr(target, name)
        if is_dataclass(inner):
            _fill(inner, value, f"{where}{key}.")
        else:
            setattr(target, name, value)


def from_toml(text: str, base: Config | None = None) -> Config:
    out = base or Config()
    _fill(out, tomllib.loads(text))
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice", description="Loads dumps into verified Parquet tables.")
    p.add_argument("--config", help="TOML file")
    p.add_argument("-d", dest="source", help="source folder")
    p.add_argument("--target", help="target folder")
    p.add_argument("-f", dest="filter", action="append", help="table filter, may be repeated")
    p.add_argument("--no-schema", action="store_true", default=None)
    p.add_argument("--on-duplicate", choices=POLICIES)
    p.add_argument("--checksum", choices=LEVELS)
    p.add_argument("--analyze", choices=LEVELS)
    p.add_argument("--enable-checkpoint", choices=("true", "false"))
    p.add_argument("--server", metavar="HOST:PORT", help="serve a task queue")
    for verb in ("remove", "error-ignore", "error-destroy", "dump"):
        p.add_argument(f"--checkpoint-{verb}", metavar="TABLE|all" if verb != "dump" else "FOLDER")
    return p


def from_args(args: argparse.Namespace) -> Config:
    out = Config()
    if args.config:
        with open(args.config) as f:
            from_toml(f.read(), out)
    for where, name, value in (
        (out.source, "data_source_dir", args.source), (out.target, "dir", args.target), (out.source, "filter", args.filter), (out.source, "no_schema", args.no_schema),
        (out.target, "on_duplicate", args.on_duplicate), (out.post_restore, "checksum", args.checksum), (out.post_restore, "analyze", args.analyze),
        (out.checkpoint, "enable", None if args.enable_checkpoint is None else args.enable_checkpoint == "true"),
    ):
        if value is not None:
            setattr(where, name, value)
    return out
