"""The file layer of tasks: addresses, listing, reading, and writing that a retry may repeat.

Its functions travel with the job, so executors need no copy of the package.
"""

import os
import sys
import uuid
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle

CHUNK = 1 << 20


def file_uri(root: str) -> str:
    """Address for the file layer: object stores go by `s3`, local files by a bare path."""
    if root.startswith(("s3a://", "s3n://")):
        return "s3://" + root[6:]
    if root.startswith("file:"):
        return "/" + root[5:].lstrip("/")
    return root


def store_of(uri: str) -> tuple:
    """(file system, path of the root in it)."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(uri)
    return store, base.rstrip("/") or base


def list_folder(store, path: str) -> Iterator[tuple[str, int | None]]:
    """(path, size) of what lies in one folder, None as the size of a folder.

    Local folders are read entry by entry, links to folders are not followed. A folder of an object
    store comes page by page from its file system, as a list that lasts for this folder only.
    """
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(path) as entries:
            for entry in entries:
                if entry.is_dir(follow_symlinks=False):
                    yield entry.path, None
                elif entry.is_file():
                    yield entry.path, entry.stat().st_size
    else:
        for found in store.get_file_info(fs.FileSelector(path, recursive=False)):
            if found.type == fs.FileType.Directory:
                yield found.path, None
            elif found.type == fs.FileType.File:
                yield found.path, found.size


def read_bytes(store, path: str, limit: int | None = None) -> bytes | None:
    """The first `limit` bytes of a file, or all; None if it is gone."""
    try:
        with store.open_input_stream(path, compression=None) as stream:
            return stream.read() if limit is None else stream.read(limit)
    except FileNotFoundError:
        return None


def chunks_of(stream) -> Iterator[bytes]:
    while chunk := stream.read(CHUNK):
        yield chunk


def write_aside(store, path: str, chunks: Iterable[bytes]) -> tuple[str, int]:
    """Write beside `path` under a name of this attempt's own; gives that name and the size."""
    store.create_dir(path.rpartition("/")[0], recursive=True)
    aside, size = f"{path}.{uuid.uuid4().hex}.part", 0
    try:
        with store.open_output_stream(aside, compression=None) as out:
            for chunk in chunks:
                out.write(chunk)
                size += len(chunk)
    except BaseException:
        store.delete_file(aside)
        raise
    return aside, size


def write_file(store, path: str, chunks: Iterable[bytes]) -> int:
    """Write a file that appears under its name only when it is whole; a retry replaces it."""
    aside, size = write_aside(store, path, chunks)
    store.move(aside, path)
    return size


cloudpickle.register_pickle_by_value(sys.modules[__name__])
