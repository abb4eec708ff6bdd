"""Build configuration."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

from barloom.sources.tables import codec

PATH_KEYS = ("database_dir", "consumer_dir", "day_source", "day_index_source", "minute_source", "minute_index_source")
# Which adapter reads which configured folder.
SOURCE_KEYS = {"day": "day_source", "day_idx": "day_index_source", "minute": "minute_source", "minute_idx": "minute_index_source"}


@dataclass(frozen=True)
class BuildConfig:
    """`fingerprint` is `content` (hash every file on every build) or `stat` (size and time).

    `consumer_dir`, if named, gets the consumer layout as well: one file per symbol and timeframe.
    `spark_conf` holds the chosen profile: settings for whoever starts the session.
    """

    database_dir: str
    day_source: str
    minute_source: str
    day_index_source: str | None = None
    minute_index_source: str | None = None
    consumer_dir: str | None = None
    compression: str = "zstd"
    fingerprint: str = "content"
    profile: str = "local"
    spark_conf: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        codec(self.compression)

    def folder(self, kind: str) -> str | None:
        return getattr(self, SOURCE_KEYS[kind])


def load_config(path: str, profile: str = "local") -> BuildConfig:
    with open(path, encoding="utf-8") as stream:
        return resolve(json.load(stream), os.path.dirname(os.path.abspath(path)), profile)


def resolve(raw: dict, base: str, profile: str = "local") -> BuildConfig:
    """Relative folders count from `base`; URIs stay as they are; the profile's keys win."""
    chosen = raw.get("profiles", {}).get(profile, {})
    values = {**raw, **chosen}
    for key in PATH_KEYS:
        if values.get(key) and "://" not in values[key]:
            values[key] = os.path.normpath(os.path.join(base, values[key]))
    known = {f.name for f in fields(BuildConfig)} - {"profile", "spark_conf"}
    settings = {k: v for k, v in chosen.items() if k.startswith("spark.")}
    return BuildConfig(**{k: v for k, v in values.items() if k in known}, profile=profile, spark_conf=settings)
