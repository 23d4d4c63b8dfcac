"""Rule sets and the strict YAML loader."""
from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path


class UnknownRuleKey(ValueError):
    """A rules file holds a key that no setting reads (usually a typo)."""


@dataclass(frozen=True)
class Rules:
    required_columns: tuple[str, ...] = ()
    non_null_columns: tuple[str, ...] = ()
    unique_columns: tuple[str, ...] = ()
    positive_numeric_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    allowed_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    null_thresholds: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class DatasetSettings:
    input_path: str | None = None
    output_dir: str = "reports/latest"
    dtypes: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    dataset: DatasetSettings = field(default_factory=DatasetSettings)
    checks: Rules = field(default_factory=Rules)


def _section(raw: dict, cls: type, title: str) -> dict:
    known = {f.name for f in fields(cls)}
    strangers = [str(key) for key in raw if key not in known]
    if strangers:
        raise UnknownRuleKey(
            f"{title} holds unknown keys {sorted(strangers)}; known keys are {sorted(known)}"
        )
    # A key left empty in YAML loads as None and means "not set".
    return {key: value for key, value in raw.items() if value is not None}


def rules_from_mapping(raw: dict | None) -> Rules:
    given = _section(raw or {}, Rules, "checks")
    built: dict = {}
    for name, value in given.items():
        if name == "allowed_values":
            built[name] = {col: tuple(map(str, vals)) for col, vals in value.items()}
        elif name == "null_thresholds":
            built[name] = {col: float(limit) for col, limit in value.items()}
        else:
            built[name] = tuple(value)
    return Rules(**built)


def config_from_mapping(raw: dict | None) -> Config:
    given = _section(raw or {}, Config, "top level")
    dataset = _section(given.get("dataset") or {}, DatasetSettings, "dataset")
    if "dtypes" in dataset:
        dataset["dtypes"] = {str(col): str(kind) for col, kind in dataset["dtypes"].items()}
    return Config(DatasetSettings(**dataset), rules_from_mapping(given.get("checks")))


def load_config(path: str | Path) -> Config:
    """Read a rules file.  Only plain YAML is accepted; object tags are an error."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return config_from_mapping(yaml.safe_load(handle))
