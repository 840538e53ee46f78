"""Settings from the environment."""

from __future__ import annotations

import os


class MissingSetting(KeyError):
    """A setting that must be there is not."""


def setting(name: str, default: str | None = None) -> str:
    value = os.environ.get(name, default)
    if not value:
        raise MissingSetting(name)
    return value


def load_dotenv(path: str) -> None:
    """NAME=value lines into the environment, where they are not set yet."""
    with open(path, encoding="utf-8") as f:
        for line in map(str.strip, f):
            if line and not line.startswith("#") and "=" in line:
                name, value = line.removeprefix("export ").split("=", 1)
                os.environ.setdefault(name.strip(), value.strip().strip("'\""))
