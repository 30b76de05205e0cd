"""Files in the shared folder, by whatever scheme the cluster names."""

from __future__ import annotations

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri)


def made(uri: str) -> tuple[fs.FileSystem, str]:
    """The same, the folder there from now on."""
    system, path = at(uri)
    system.create_dir(path, recursive=True)
    return system, path
