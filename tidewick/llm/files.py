"""Binary files in the shared folder, from tasks: local mounts and object stores by URI."""

from __future__ import annotations

from contextlib import contextmanager


def _at(path: str):
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)


def create(path: str):
    """An output stream; folders on the way are made."""
    system, name = _at(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name)


@contextmanager
def opened(path: str):
    """(read(offset, length), size) of a file; only the ranges asked for are read."""
    system, name = _at(path)
    with system.open_input_file(name) as file:
        yield (lambda offset, length: file.read_at(length, offset)), file.size()
