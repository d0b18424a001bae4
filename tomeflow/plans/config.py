"""Which sources an integration run reads, from a small YAML file."""

from __future__ import annotations

from dataclasses import dataclass, field

SOURCES = ("bx", "az2014", "az2018", "goodreads")


@dataclass
class Config:
    enabled: dict[str, bool] = field(default_factory=lambda: dict.fromkeys(SOURCES, True))
    options: dict[str, dict[str, str]] = field(default_factory=dict)

    def is_enabled(self, name: str) -> bool:
        """``az14`` and ``AZ18`` are short names; ``loc`` and ``ol`` cannot be switched off."""
        short = {"az14": "az2014", "az18": "az2018", "gr": "goodreads"}
        name = short.get(name.lower(), name.lower())
        return name not in SOURCES or self.enabled.get(name, False)


def parse_config(text: str) -> Config:
    """Sections of ``key: value`` lines, two levels deep."""
    out, section = Config(dict.fromkeys(SOURCES, False)), None
    for raw in text.splitlines():
        line = raw.split("#", 1)[0].rstrip()
        if not line.strip():
            continue
        key, _, value = line.strip().partition(":")
        value = value.strip().strip("\"'")
        if not line[0].isspace():
            section = key
        elif section:
            out.options.setdefault(section, {})[key] = value
            if key == "enabled" and section in SOURCES:
                out.enabled[section] = value.lower() in ("true", "yes", "on")
    return out


def load_config(path: str) -> Config:
    with open(path) as f:
        return parse_config(f.read())
