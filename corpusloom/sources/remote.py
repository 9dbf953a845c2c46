"""Files opened in tasks, on whatever file system their path names."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it. Paths without a scheme are of a file system that all machines see."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def tail(path: str, n: int) -> tuple[bytes, int]:
    """The last ``n`` bytes of a file, or all of a shorter one, and its size."""
    files, name = opened(path)
    with files.open_input_file(name) as f:
        size = f.size()
        f.seek(max(0, size - n))
        return f.read(min(n, size)), size


def whole(path: str) -> bytes:
    files, name = opened(path)
    with files.open_input_stream(name) as f:
        return f.read()


def put(path: str, content: bytes) -> None:
    """Writes a file under a name of its own and renames it, so one that is there is whole."""
    files, name = opened(path)
    files.create_dir(os.path.dirname(name), recursive=True)
    part = f"{os.path.dirname(name)}/.{os.path.basename(name)}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(content)
    files.move(part, name)
