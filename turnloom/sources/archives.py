"""Folders as tar.gz files, for artefacts that tables only point at."""

from __future__ import annotations

import os
import tarfile
from collections.abc import Iterable


def pack_folder(folder: str, target: str, names: Iterable[str] | None = None, top: str | None = None) -> list[str]:
    """Write the files of a folder, or those of ``names`` that exist, under one top folder.

    The archive appears by a rename; returns the names that went in, in order.
    """
    top = top or os.path.basename(os.path.normpath(folder))
    found = sorted(os.listdir(folder)) if names is None else [n for n in names if os.path.exists(os.path.join(folder, n))]
    with tarfile.open(f"{target}.new", "w:gz") as tar:
        for name in found:
            tar.add(os.path.join(folder, name), arcname=f"{top}/{name}")
    os.replace(f"{target}.new", target)
    return found


def unpack_folder(path: str, target: str) -> str:
    """Unpack an archive of exactly one top folder; returns that folder.

    Absolute names, names that lead out of the target, links and devices are refused before
    anything is written.
    """
    with tarfile.open(path, "r:gz") as tar:
        members = tar.getmembers()
        tops = {m.name.split("/")[0] for m in members}
        for m in members:
            inside = os.path.normpath(m.name)
            if os.path.isabs(m.name) or inside.startswith("..") or not (m.isfile() or m.isdir()):
                raise ValueError(f"{path}: {m.name} must not be unpacked")
        if len(tops) != 1 or tops & {".", ""}:
            raise ValueError(f"{path}: expected one top folder, found {sorted(tops)}")
        tar.extractall(target, filter="data")
    return os.path.join(target, tops.pop())
