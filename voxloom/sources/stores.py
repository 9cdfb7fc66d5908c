"""Files of a shared store, for data sources whose Python code opens them itself."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """(store, path inside of it, what a path gets in front to be a Spark path) for an absolute path or a URI."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    store, inside = fs.FileSystem.from_uri(path)
    if isinstance(store, fs.LocalFileSystem):
        return store, inside, "file:"
    return store, inside, path[: len(path) - len(inside)] if path.endswith(inside) else f"{path.split('://')[0]}://"


def files_below(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """All files of a folder tree in order of their paths; none for a folder that is not there."""
    found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path)
