from __future__ import annotations

import pytest
import yaml

from assayframe.rules import UnknownRuleKey, load_config


def write(tmp_path, text):
    path = tmp_path / "rules.yml"
    path.write_text(text, encoding="utf-8")
    return path


@pytest.mark.parametrize("text, stranger", [
    ("datasett: {}\nchecks: {}\n", "datasett"),
    ("dataset: {output_directory: x}\n", "output_directory"),
    ("checks: {null_threshholds: {a: 0.5}}\n", "null_threshholds"),
])
def test_unknown_keys_are_errors(tmp_path, text, stranger):
    with pytest.raises(UnknownRuleKey, match=stranger):
        load_config(write(tmp_path, text))


def test_values_are_coerced(tmp_path):
    config = load_config(write(tmp_path, """
dataset: {input_path: data/ăîșțé.csv, dtypes: {id: str}}
checks:
  required_columns: [id]
  non_null_columns: []
  allowed_values: {country: [NL, 1, true]}
  null_thresholds: {mcc: 1}
"""))
    assert config.dataset.input_path == "data/ăîșțé.csv"
    assert config.dataset.dtypes == {"id": "str"}
    assert config.checks.allowed_values == {"country": ("NL", "1", "True")}
    assert config.checks.null_thresholds == {"mcc": 1.0}
    assert config.checks.required_columns == ("id",)


@pytest.mark.parametrize("text", ["", "{}", "checks:\n", "dataset:\nchecks:\n  unique_columns:\n"])
def test_absent_sections_are_defaults(tmp_path, text):
    config = load_config(write(tmp_path, text))
    assert config.dataset.input_path is None
    assert config.dataset.output_dir == "reports/latest"
    assert config.checks.unique_columns == ()


def test_bad_files(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "absent.yml")
    with pytest.raises(yaml.YAMLError):
        load_config(write(tmp_path, "dataset: : :\n  bogus"))
    with pytest.raises(ValueError):
        load_config(write(tmp_path, "checks: {null_thresholds: {mcc: many}}"))
    with pytest.raises(yaml.YAMLError):
        load_config(write(tmp_path, "checks: !!python/object/apply:os.getcwd []"))
