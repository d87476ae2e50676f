"""Settings: a file over defaults, the environment over the file, arguments over both."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 6_000
    chunk_overlap: int = 500
    call_spacing: float = 2.0
    call_attempts: int = 5
    store_url: str = "sandbox"
    threshold: float = 0.8


def load_settings(path: str | None = None, env: dict | None = None, **arguments) -> Settings:
    """Settings from JSON or, if the library is there, YAML; a file that cannot be read leaves the defaults. None is no argument."""
    told: dict = {}
    if path:
        try:
            with open(path) as f:
                text = f.read()
            try:
                told = json.loads(text)
            except ValueError:
                import yaml

                told = yaml.safe_load(text) or {}
        except Exception:  # noqa: BLE001
            told = {}
    known = {f.name: type(f.default) for f in fields(Settings)}
    env = os.environ if env is None else env
    told = {k: v for k, v in told.items() if k in known} if isinstance(told, dict) else {}
    told |= {k: env[f"RECORDLOOM_{k.upper()}"] for k in known if f"RECORDLOOM_{k.upper()}" in env}
    told |= {k: v for k, v in arguments.items() if k in known and v is not None}
    return replace(Settings(), **{k: known[k](v) for k, v in told.items()})
