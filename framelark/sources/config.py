"""Configuration from a TOML text."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field


@dataclass(frozen=True)
class AudioSource:
    file: str
    stream: int | None = None


@dataclass(frozen=True)
class Config:
    data_dir: str = "data"
    video: str | None = None
    audio: dict[str, AudioSource] = field(default_factory=dict)
    subtitles: dict[str, str] = field(default_factory=dict)


def source(text: str) -> AudioSource:
    """file, or file#stream."""
    file, mark, stream = text.rpartition("#")
    return AudioSource(file, int(stream)) if mark and stream.isdigit() else AudioSource(text)


def parse(text: str) -> Config:
    values = tomllib.loads(text)
    audio = {k: source(v) for k, v in values.get("audio", {}).items()}
    return Config(values.get("data_dir", "data"), values.get("video"), audio, dict(values.get("subtitles", {})))
