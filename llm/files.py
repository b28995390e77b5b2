"""Files that tasks write to and read from the shared folder, by the folder's own URI.

A task names every file it writes anew and returns the name; only names in a written manifest count. A repeated task
leaves an unnamed file behind and never half of a named one.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def create(folder: str, suffix: str):
    """Yields (name, stream) of a new file in ``folder``."""
    name = f"{folder}/{uuid.uuid4().hex}{suffix}"
    store, path = located(name)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path, compression=None) as stream:
        yield name, stream


@contextmanager
def reading(name: str):
    """A stream that can seek."""
    store, path = located(name)
    with store.open_input_file(path) as stream:
        yield stream
