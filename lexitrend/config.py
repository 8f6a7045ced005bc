"""Job settings from a JSON file of named sections.

    {"Economy": {"data_file": "econ.csv", "output": "out/econ", "academic_stopwords": ["paper", ...]}}

A section needs ``data_file``; everything else has the value of ``constants`` unless it is given.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from . import constants as K


@dataclass(frozen=True)
class JobConfig:
    """Settings of one section."""
    data_file: str
    output: str | None = None
    academic_stopwords: list[str] = field(default_factory=lambda: list(K.ACADEMIC_STOPWORDS))
    search_terms: list[str] = field(default_factory=lambda: list(K.SEARCH_PHRASES))
    min_df: dict[int, int] = field(default_factory=lambda: dict(K.MIN_DF))
    min_docs_per_year: int = K.MIN_DOCS_PER_YEAR
    top_terms: int = K.TOP_TERMS_PER_CATEGORY


def load_config(path: str, section: str) -> JobConfig:
    """The settings of ``section``; a missing file, section, data file or an unknown or wrong setting is an error."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except FileNotFoundError:
        raise FileNotFoundError(f"no configuration file {path}") from None
    if section not in found:
        raise KeyError(f"{path} has no section {section!r}, only {', '.join(found) or 'none'}")
    given = dict(found[section])
    kinds = {f.name: f.type for f in fields(JobConfig)}
    if unknown := sorted(set(given) - set(kinds)):
        raise ValueError(f"{path}, {section}: unknown settings {', '.join(unknown)}")
    if not isinstance(given.get("data_file"), str):
        raise ValueError(f"{path}, {section}: data_file is missing")
    for name in ("academic_stopwords", "search_terms"):
        if not all(isinstance(w, str) for w in given.get(name, [])):
            raise ValueError(f"{path}, {section}: {name} must be a list of words")
    for name in ("min_docs_per_year", "top_terms"):
        if not isinstance(given.get(name, 1), int):
            raise ValueError(f"{path}, {section}: {name} must be a whole number")
    if "min_df" in given:
        given["min_df"] = {int(n): int(k) for n, k in given["min_df"].items()}
    return JobConfig(**given)
