"""Files of their own in the shared folder, for writers that Spark has no format for.

Tasks write to a temporary name and rename; a task that runs again writes the same bytes to the
same final name. What belongs to a finished write is what its manifest lists.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_store(base: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or an absolute path."""
    return fs.FileSystem.from_uri(base)


def write_file(store: fs.FileSystem, path: str, data: bytes) -> None:
    """All of a file at once: temporary name, then rename."""
    with Staged(store, path) as out:
        out.write(data)


class Staged:
    """An output stream under a temporary name that gets its own name when it ends well."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.store, self.path = store, path
        self.temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        self.out = store.open_output_stream(self.temporary, compression=None)

    def __enter__(self):
        return self.out

    def __exit__(self, kind, *_):
        if self.out is None:
            return
        self.out.close()
        self.out = None
        if kind is None:
            self.store.move(self.temporary, self.path)
        else:
            self.store.delete_file(self.temporary)


def clear_strays(store: fs.FileSystem, folder: str) -> None:
    """Delete what tasks that were lost left under temporary names."""
    for info in store.get_file_info(fs.FileSelector(folder)):
        if info.path.endswith(".tmp"):
            store.delete_file(info.path)
