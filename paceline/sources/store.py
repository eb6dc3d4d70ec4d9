"""A folder of files that several writers share, each write conditional on what was read."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Callable
from pathlib import Path


class Conflict(Exception):
    """Another writer came between."""


class LocalStore:
    """Files with a token that changes with each write."""

    def __init__(self, folder: str):
        self.folder = Path(folder)
        self.folder.mkdir(parents=True, exist_ok=True)

    def names(self) -> dict[str, int]:
        return {p.name: p.stat().st_size for p in sorted(self.folder.iterdir()) if p.is_file() and not p.name.startswith(".")}

    def token(self, name: str) -> int | None:
        try:
            return (self.folder / name).stat().st_mtime_ns
        except FileNotFoundError:
            return None

    def read(self, name: str) -> tuple[bytes | None, int | None]:
        at = self.token(name)
        return (None if at is None else (self.folder / name).read_bytes()), at

    def write(self, name: str, data: bytes, token: int | None) -> None:
        """Replace the file as a whole, if it still is what `token` was read from."""
        handle, temporary = tempfile.mkstemp(dir=self.folder, prefix=".")
        try:
            with os.fdopen(handle, "wb") as f:
                f.write(data)
            if self.token(name) != token:
                raise Conflict(name)
            os.replace(temporary, self.folder / name)
        finally:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(temporary)


def update(store: LocalStore, name: str, change: Callable[[bytes | None], bytes | None], tries: int = 5) -> bool:
    """Read, change and write, again after a conflict; whether anything was written (a change to None writes nothing)."""
    for k in range(tries):
        held, token = store.read(name)
        new = change(held)
        if new is None or new == held:
            return False
        try:
            store.write(name, new, token)
            return True
        except Conflict:
            if k == tries - 1:
                raise
    return False


def sync(store: LocalStore, folder: str) -> list[str]:
    """Copy files that the folder lacks or holds in another size."""
    to, copied = Path(folder), []
    to.mkdir(parents=True, exist_ok=True)
    for name, size in store.names().items():
        if not (to / name).is_file() or (to / name).stat().st_size != size:
            (to / name).write_bytes(store.read(name)[0] or b"")
            copied.append(name)
    return copied
