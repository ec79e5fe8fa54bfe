"""Files by address from inside tasks: local and shared folders, and the stores that pyarrow knows."""

from __future__ import annotations

import posixpath
import re
import uuid

from pyarrow import fs


def place(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it; an address without scheme is a local path."""
    if re.match(r"[a-z][a-z0-9+.-]+:", address):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", address))
    return fs.LocalFileSystem(), address


def size_of(address: str) -> int | None:
    """Bytes of a file; null if there is none."""
    store, path = place(address)
    info = store.get_file_info(path)
    return info.size if info.type == fs.FileType.File else None


def written(address: str, content: bytes) -> None:
    """Writes under another name and renames, so readers see all of a file or none."""
    store, path = place(address)
    store.create_dir(posixpath.dirname(path), recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(beside) as f:
        f.write(content)
    store.move(beside, path)


def sizes_below(folder: str) -> dict[str, int]:
    """Bytes of each file by its path below the folder; temporary files and those whose folder or own name begins with _ are none."""
    store, root = place(folder.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    below = {posixpath.relpath(i.path, root): i.size for i in found if i.type == fs.FileType.File}
    return {p: n for p, n in below.items() if not p.endswith(".tmp") and not any(x.startswith("_") for x in p.split("/"))}


def removed(address: str) -> None:
    """Removes a file or a folder with all in it; nothing happens if there is none."""
    store, path = place(address)
    kind = store.get_file_info(path).type
    if kind == fs.FileType.File:
        store.delete_file(path)
    elif kind == fs.FileType.Directory:
        store.delete_dir(path)
