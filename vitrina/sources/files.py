"""Files read in blocks inside tasks, on any filesystem that pyarrow opens."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote

BLOCK = 8 << 20


def opened(path: str) -> tuple:
    """The pyarrow filesystem of a path, as Spark names it, and the name there."""
    from pyarrow import fs as pafs
    uri = path if "://" in path else path.replace("file:", "file://", 1)
    return pafs.FileSystem.from_uri(quote(uri, safe="/:@"))


def blocks_of(path: str, block: int = BLOCK) -> Iterator[bytes]:
    """The bytes of a file, as Spark names it, a block at a time."""
    filesystem, name = opened(path)
    with filesystem.open_input_stream(name) as stream:
        while data := stream.read(block):
            yield data


def entries_in(path: str) -> Iterator[tuple[str, bool]]:
    """Names of the files and folders that lie directly in a folder, and whether each is a file.

    A local folder is listed as a stream.  pyarrow lists others at once, in the memory of the one task that asks.
    """
    from pyarrow import fs as pafs
    filesystem, folder = opened(path)
    if isinstance(filesystem, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            yield from ((f.name, f.is_file()) for f in found if f.is_file() or f.is_dir())
    else:
        yield from ((f.base_name, f.type == pafs.FileType.File) for f in filesystem.get_file_info(pafs.FileSelector(folder)))
