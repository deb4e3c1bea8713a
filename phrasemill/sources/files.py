"""Files of local and object stores, opened in tasks by ``pyarrow.fs``: ranges are read without the rest of a file."""

from __future__ import annotations

import fnmatch
import uuid

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or address and the place in it. Spark's ``file:/x`` and ``s3a://x`` are understood."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    elif colon and scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    return fs.FileSystem.from_uri(path)


def opened_by_tasks(path: str) -> bool:
    """Whether tasks can open ``path`` without Spark's own readers."""
    scheme, colon, _ = path.partition(":")
    return not colon or "/" in scheme or scheme in ("file", "s3", "s3a", "s3n", "gs", "gcs")


def listed(pattern: str) -> list[str]:
    """The files that ``pattern`` names, in order: one file, all of a folder, or those that fit wildcards in the last part."""
    store, place = located(pattern)
    folder, _, last = place.rpartition("/")
    if any(c in last for c in "*?["):
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.path for f in found if f.is_file and fnmatch.fnmatchcase(f.base_name, last))
    info = store.get_file_info(place)
    if info.type == fs.FileType.Directory:
        return sorted(f.path for f in store.get_file_info(fs.FileSelector(place)) if f.is_file and not f.base_name.startswith((".", "_")))
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(pattern)
    return [place]


def put_file(store: fs.FileSystem, place: str, chunks) -> int:
    """Write ``place`` from pieces of bytes under another name and move it: a task that dies leaves no part of it. Gives its size."""
    folder, _, name = place.rpartition("/")
    store.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    size = 0
    try:
        with store.open_output_stream(draft) as out:
            for chunk in chunks:
                out.write(chunk)
                size += len(chunk)
        store.move(draft, place)
    except BaseException:
        if store.get_file_info(draft).is_file:
            store.delete_file(draft)
        raise
    return size
