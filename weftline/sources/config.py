"""Settings: defaults that change results, and a reader of key = value files."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    max_insert_size: int = 500
    mt_chromosome: str = "MT"
    dna_concordant_length: int = 2000
    discord_read_trim: int = 50
    clustering_precision: float = 0.95
    span_count_threshold: int = 5
    percent_identity_threshold: float = 0.90
    split_min_anchor: int = 4
    splice_bias: int = 10
    probability_threshold: float = 0.50
    covariance_sampling_density: float = 0.01
    max_paired_alignments: int = 10
    reads_per_job: int = 1_000_000


def parse(text: str) -> dict[str, str]:
    """key = value lines; ``$(key)`` stands for another value, cycles are an error."""
    raw = {}
    for line in text.splitlines():
        line = line.split("#", 1)[0].strip()
        if line:
            key, _, value = line.partition("=")
            raw[key.strip()] = value.strip()

    def value(key: str, above: tuple[str, ...]) -> str:
        if key in above:
            raise ValueError(f"{key} stands for itself")
        return re.sub(r"\$\(([^)]+)\)", lambda m: value(m[1], (*above, key)), raw[key])

    return {key: value(key, ()) for key in raw}


def numbered(values: dict[str, str], key: str) -> list[str]:
    """Values of key1, key2, ... up to the first gap."""
    out = []
    while f"{key}{len(out) + 1}" in values:
        out.append(values[f"{key}{len(out) + 1}"])
    return out


def listed(values: dict[str, str], key: str) -> set[str]:
    return {x.strip() for x in values[key].split(",") if x.strip()}


def settings(values: dict[str, str]) -> Settings:
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    return Settings(**{k: kinds[k](v) for k, v in values.items() if k in kinds})
