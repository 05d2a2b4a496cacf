"""Small file helpers used inside tasks: local paths or any URI Arrow can open."""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from typing import BinaryIO


def local_path(path: str) -> str | None:
    """The plain path of a local location, or None for a remote URI."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return None if "://" in path else path


def remote(uri: str):
    """Arrow file system and inner path of a URI; Hadoop's names for S3 are known."""
    from pyarrow import fs

    scheme, rest = uri.split("://", 1)
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    return fs.FileSystem.from_uri(f"{scheme}://{rest}")


def open_binary(path: str) -> BinaryIO:
    local = local_path(path)
    if local is not None:
        return open(local, "rb")
    filesystem, inner = remote(path)
    return filesystem.open_input_file(inner)


def _utf8(name: str) -> str:
    """Names that are not UTF-8 keep a readable form; such files cannot be opened."""
    return os.fsencode(name).decode("utf-8", "replace")


def subdirs(path: str) -> list[str]:
    """Names of the direct sub-directories, sorted."""
    local = local_path(path)
    if local is not None:
        with os.scandir(local) as entries:
            return sorted(_utf8(e.name) for e in entries if e.is_dir())
    from pyarrow import fs

    filesystem, inner = remote(path)
    infos = filesystem.get_file_info(fs.FileSelector(inner))
    return sorted(i.base_name for i in infos if i.type == fs.FileType.Directory)


def root_kind(path: str) -> str:
    """missing, directory or other."""
    local = local_path(path)
    if local is not None:
        if not os.path.exists(local):
            return "missing"
        return "directory" if os.path.isdir(local) else "other"
    from pyarrow import fs

    filesystem, inner = remote(path)
    kind = filesystem.get_file_info(inner).type
    if kind == fs.FileType.NotFound:
        return "missing"
    return "directory" if kind == fs.FileType.Directory else "other"


def file_stat(path: str) -> tuple[int, int] | None:
    """(size, mtime ns) of a local regular file; None if it is none, or gone."""
    try:
        info = os.stat(local_path(path))
    except OSError:
        return None
    return (info.st_size, info.st_mtime_ns) if stat.S_ISREG(info.st_mode) else None


def regular_files(
    path: str, wanted=lambda rel: True, names_only: bool = False
) -> Iterator[tuple[str, str, int | None, int | None]]:
    """(relative path, absolute path, size, mtime ns) of each regular file below.

    Directories reached through a link are not entered; linked files count by
    their target. `wanted` is asked before a file is looked at. With
    `names_only` local files are not looked at yet: size and time are None, and
    special files are still among them.
    """
    local = local_path(path)
    if local is None:
        yield from _remote_files(path, wanted)
        return
    pending = [("", local)]
    while pending:
        prefix, directory = pending.pop()
        try:
            with os.scandir(directory) as listing:
                entries = list(listing)
        except OSError:
            continue
        for entry in entries:
            rel = prefix + _utf8(entry.name)
            if entry.is_dir():
                if not entry.is_symlink():
                    pending.append((rel + "/", entry.path))
                continue
            if not wanted(rel):
                continue
            if names_only:
                yield rel, _utf8(entry.path), None, None
                continue
            try:
                info = entry.stat()
            except FileNotFoundError:
                continue
            if stat.S_ISREG(info.st_mode):
                yield rel, _utf8(entry.path), info.st_size, info.st_mtime_ns


def _remote_files(path: str, wanted) -> Iterator[tuple[str, str, int, int]]:
    from pyarrow import fs

    filesystem, inner = remote(path)
    root = inner.rstrip("/") + "/"
    pending = [inner]
    while pending:
        for info in filesystem.get_file_info(fs.FileSelector(pending.pop())):
            if info.type == fs.FileType.Directory:
                pending.append(info.path)
                continue
            rel = info.path[len(root):]
            if info.type == fs.FileType.File and wanted(rel):
                yield rel, path.rstrip("/") + "/" + rel, info.size, info.mtime_ns or 0
