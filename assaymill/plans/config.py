"""Hash-locked run configuration and the scope of input files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from ..sinks.release import sha256_file


class ScopeError(ValueError):
    """The files found are not the files declared."""


@dataclass(frozen=True)
class RunConfig:
    """Inputs with their locked hashes, and the role of each sheet."""

    root: Path
    release_version: str
    inputs: dict[str, str]
    sheet_roles: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, root: str) -> RunConfig:
        """Read a JSON (or, where a reader is installed, YAML) file; every input must exist and have its locked hash."""
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yml", ".yaml")):
            import yaml

            found = yaml.safe_load(text) or {}
        else:
            found = json.loads(text)
        missing = {"release_version", "inputs"} - set(found)
        if missing:
            raise ValueError(f"missing settings: {sorted(missing)}")
        config = cls(Path(root).resolve(), str(found["release_version"]), dict(found["inputs"]), dict(found.get("sheet_roles", {})))
        config.verify()
        return config

    def verify(self) -> None:
        for name, locked in self.inputs.items():
            file = (self.root / name).resolve()
            if not file.is_relative_to(self.root):
                raise ScopeError(f"outside the root: {name}")
            if not file.is_file():
                raise ScopeError(f"missing: {name}")
            if sha256_file(file) != locked:
                raise ScopeError(f"changed: {name}")


def resolve_scope(root: str, declared: list[str], selected: list[str]) -> list[Path]:
    """The selected files in declared order; they must be exactly the declared ones, inside the root."""
    base = Path(root).resolve()
    paths = {(base / s).resolve() for s in selected}
    wanted = [(base / s).resolve() for s in declared]
    if not selected:
        raise ScopeError("no file selected")
    problems = [f"outside: {p}" for p in sorted(paths) if not p.is_relative_to(base)]
    problems += [f"missing: {p}" for p in wanted if p not in paths or not p.is_file()] + [f"unexpected: {p}" for p in sorted(paths - set(wanted)) if p.is_relative_to(base)]
    if problems:
        raise ScopeError("; ".join(problems))
    return wanted
