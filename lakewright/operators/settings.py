"""Profiling settings: built-in values, overridden by a mapping or a YAML/JSON file."""

from __future__ import annotations

import copy
import json
from pathlib import Path

# Thresholds, placeholder lists and display settings.
DEFAULTS: dict = {
    "quality_score_thresholds": {
        "excellent": {"max_missing_pct": 5, "max_critical_issues": 0},
        "good": {"max_missing_pct": 10, "max_critical_issues": 2},
        "fair": {"max_missing_pct": 20, "max_critical_issues": 5},
    },
    "missingness_thresholds": {"critical": 0, "high": 20, "moderate": 10},
    "sentinel_detection": {
        "numeric_sentinels": [999, 9999, -999, -9999, -1, 99, 88, 77],
        "string_sentinels": [
            "NA", "N/A", "NULL", "UNKNOWN", "UNK", "MISSING", "NOT RECORDED",
        ],
        "min_frequency_pct": 1.0,
        "max_unique_for_detection": 50,
    },
    "identifier_columns": [
        "ACCOUNTNO", "MEDRECNO", "TRAUMANO", "account_number", "mrn", "trauma_no", "cisir_id",
    ],
    "identifier_patterns": [
        "_id$", "_no$", "^id_", "^accountno", "^medrecno", "^traumano",
    ],
    "display": {"top_n_categories": 15, "decimal_places": 2},
}


def merged(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for key, value in over.items():
        nested = isinstance(value, dict) and isinstance(out.get(key), dict)
        out[key] = merged(out[key], value) if nested else copy.deepcopy(value)
    return out


def profiling_settings(source: dict | str | None = None) -> dict:
    """Settings with ``source`` laid over the built-in values; a missing file means none."""
    if source is None:
        return copy.deepcopy(DEFAULTS)
    if isinstance(source, dict):
        return merged(DEFAULTS, source)
    path = Path(source)
    if not path.exists():
        return copy.deepcopy(DEFAULTS)
    text = path.read_text()
    if path.suffix == ".json":
        return merged(DEFAULTS, json.loads(text))
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading a YAML settings file needs the yaml package") from missing
    return merged(DEFAULTS, yaml.safe_load(text) or {})
