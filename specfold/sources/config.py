"""Settings: TOML files found in the working folder or above, mission parameters in a small YAML subset."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from specfold.errors import ConfigError

#: Tables between stages, by name.
STAGES = ("raw", "clean", "rejected", "reduced", "prepared", "models", "corrected", "post", "cube")


def find_config(name: str = "config.toml", start: str | Path = ".") -> Path:
    """The file in the folder or the nearest one above."""
    here = Path(start).resolve()
    for folder in (here, *here.parents):
        if (folder / name).is_file():
            return folder / name
    raise ConfigError(f"no {name} in {here} or above")


@dataclass(frozen=True)
class Config:
    tree: Mapping = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> Config:
        with open(path, "rb") as f:
            return cls(tomllib.load(f))

    def get(self, dotted: str, default: object = None) -> object:
        """A value by its path, such as gridding.beam."""
        at: object = self.tree
        for part in dotted.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        return at

    def need(self, dotted: str) -> object:
        if (found := self.get(dotted)) is None:
            raise ConfigError(f"{dotted} is not set")
        return found

    def mission(self, mission: str, name: str, default: object = None) -> object:
        """A mission's own value, else the common one."""
        own = self.get(f"missions.{mission}", {})
        return own.get(name, self.get(f"parameters.{name}", default)) if isinstance(own, Mapping) else default

    def stage_path(self, stage: str) -> str:
        if stage not in STAGES:
            raise ConfigError(f"{stage} is no stage; stages are {', '.join(STAGES)}")
        return str(self.need(f"output.{stage}"))


def load_stage(spark: SparkSession, config: Config, stage: str) -> DataFrame:
    return spark.read.parquet(config.stage_path(stage))


def save_stage(rows: DataFrame, config: Config, stage: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes a stage's table and returns it read again."""
    path = config.stage_path(stage)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return rows.sparkSession.read.parquet(path)


TEMPLATE = """[input]
raw = "raw/*.fits"

[parameters]
object = ""
beam = 14.1

[filters]
nan_below = 0.2

[reduction]
baseline = 1
smooth = 5

[pca]
n_components = 5
variance = 0.005

[output]
""" + "".join(f'{s} = "out/{s}"\n' for s in STAGES)


def scalar(text: str) -> object:
    t = text.strip()
    if len(t) > 1 and t[0] == t[-1] and t[0] in "'\"":
        return t[1:-1]
    if t.startswith("[") and t.endswith("]"):
        return [scalar(x) for x in t[1:-1].split(",") if x.strip()]
    if t.lower() in ("", "null", "~", "none"):
        return None
    if t.lower() in ("true", "yes", "false", "no"):
        return t.lower() in ("true", "yes")
    for kind in (int, float):
        try:
            return kind(t)
        except ValueError:
            continue
    return t


def parse_yaml(text: str) -> dict:
    """Nested mappings by indentation, lists of scalars (inline or by dashes), comments. No anchors, flows or multi-line texts."""
    lines = []
    for raw in text.splitlines():
        body = raw.split(" #")[0].rstrip() if not raw.lstrip().startswith("#") else ""
        if body.strip():
            lines.append((len(body) - len(body.lstrip()), body.strip()))

    def block(at: int, indent: int) -> tuple[object, int]:
        if lines[at][1].startswith("- "):
            out: list = []
            while at < len(lines) and lines[at][0] == indent and lines[at][1].startswith("- "):
                out.append(scalar(lines[at][1][2:]))
                at += 1
            return out, at
        tree: dict = {}
        while at < len(lines) and lines[at][0] == indent:
            key, colon, rest = lines[at][1].partition(":")
            if not colon:
                raise ConfigError(f"neither a key nor a list: {lines[at][1]}")
            key = scalar(key)
            at += 1
            if rest.strip():
                tree[key] = scalar(rest)
            elif at < len(lines) and (lines[at][0] > indent or (lines[at][0] == indent and lines[at][1].startswith("- "))):
                tree[key], at = block(at, lines[at][0])
            else:
                tree[key] = None
        return tree, at

    if not lines:
        return {}
    tree, end = block(0, lines[0][0])
    if end != len(lines) or not isinstance(tree, dict):
        raise ConfigError(f"indentation does not fit: {lines[min(end, len(lines) - 1)][1]}")
    return tree


def merge_yaml(text: str, mission: str, values: Mapping[str, object], block: str = "pca") -> str:
    """text with values set in a mission's block; other lines and comments stay."""
    lines = text.splitlines()
    out, done, i = [], False, 0
    while i < len(lines):
        out.append(lines[i])
        if lines[i].split(":")[0].strip() == mission and not lines[i].startswith((" ", "#")):
            i += 1
            body = []
            while i < len(lines) and (not lines[i].strip() or lines[i].startswith((" ", "\t", "#"))):
                body.append(lines[i])
                i += 1
            kept, skip = [], None
            for line in body:
                indent = len(line) - len(line.lstrip())
                if skip is not None and line.strip() and indent > skip:
                    if line.split(":")[0].strip() not in values:
                        kept.append(line)
                    continue
                skip = None
                if line.strip() == f"{block}:":
                    skip = indent
                    continue
                kept.append(line)
            own = [line for line in body if line.strip() == f"{block}:"]
            old = [line for line in kept if own and len(line) - len(line.lstrip()) > len(own[0]) - len(own[0].lstrip()) and line in body[body.index(own[0]) :]]
            out += [line for line in kept if line not in old] + [f"  {block}:", *old, *[f"    {k}: {v}" for k, v in values.items()]]
            done = True
            continue
        i += 1
    if not done:
        out += [f"{mission}:", f"  {block}:", *[f"    {k}: {v}" for k, v in values.items()]]
    return "\n".join(out) + "\n"


def mission_frame(spark: SparkSession, tree: Mapping) -> DataFrame:
    """Telluric line of each mission: mission_id, telluric_line_center, telluric_line_width (null: default)."""
    num = lambda v: None if v is None else float(v)
    return spark.createDataFrame([(str(m), num((b or {}).get("telluric_line_center")), num((b or {}).get("telluric_line_width"))) for m, b in tree.items()], "mission_id string, telluric_line_center double, telluric_line_width double")
