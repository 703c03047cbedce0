"""Text of warnings and errors: sections with a heading, nested tables indented."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


def indented(summary: Mapping, names: Mapping[str, str] | None = None, depth: int = 1) -> list[str]:
    """Lines of a nested table, one tab deeper at each level; keys by their shown names, empty parts said to be so."""
    names = names or {}
    out = []
    for key, value in summary.items():
        head = "\t" * depth + f"{names.get(key, key)}: "
        if isinstance(value, Mapping):
            out += [head, *(indented(value, names, depth + 1) or ["\t" * (depth + 1) + "{ NONE }"])]
        elif isinstance(value, (list, tuple, set, frozenset)):
            out += [head, *(["\t" * (depth + 1) + str(x) for x in value] or ["\t" * (depth + 1) + "[ NONE ]"])]
        else:
            out.append(head + str(value))
    return out


@dataclass
class Report:
    """Collects sections; errors are shown before warnings."""

    names: dict[str, str] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    def _section(self, heading: str, body) -> str:
        lines = indented(body, self.names) if isinstance(body, Mapping) else [body] if isinstance(body, str) else list(body or [])
        return "\n".join([heading, *lines])

    def error(self, heading: str, body=None) -> None:
        self.errors.append(self._section(heading, body))

    def warning(self, heading: str, body=None) -> None:
        self.warnings.append(self._section(heading, body))

    def text(self) -> str:
        bar = lambda kind: f"========[ {kind} ]".ljust(70, "=")
        return "\n\n".join(f"{bar(kind)}\n{x}" for kind, found in (("ERROR", self.errors), ("WARNING", self.warnings)) for x in found)
