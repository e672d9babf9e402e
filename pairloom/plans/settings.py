"""Settings from the environment and from a file of KEY=VALUE lines; the environment wins."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

# The names of the settings, and what holds where one is not set.
FOLDERS = {"HAN_DIR": "dataset/china", "VIET_DIR": "dataset/vietnam", "OUTPUT_DIR": "output"}
SERVICE_KEYS = ("GEMINI_API_KEY", "KANDIAN_TOKEN", "KANDIAN_EMAIL", "GOOGLE_VISION_API_KEY")

_LINE = re.compile(r"""\s*(?:export\s+)?(\w+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^#\n]*?))\s*(?:#.*)?""")


@dataclass(frozen=True)
class Settings:
    source_dir: str
    target_dir: str
    output_dir: str
    keys: Mapping[str, str] = field(default_factory=dict, repr=False)  # secrets are not printed


def from_lines(text: str) -> dict[str, str]:
    """The settings of a file's text; lines that are none are skipped."""
    found = (_LINE.fullmatch(line) for line in text.splitlines())
    return {m[1]: next((x for x in m.groups()[1:] if x is not None), "") for m in found if m}


def load(environment: Mapping[str, str] = os.environ, path: str = ".env") -> Settings:
    known: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            known = from_lines(f.read())
    known |= {k: v for k, v in environment.items() if k in FOLDERS or k in SERVICE_KEYS}
    folders = [known.get(k, default) for k, default in FOLDERS.items()]
    return Settings(*folders, keys={k: known.get(k, "") for k in SERVICE_KEYS})
