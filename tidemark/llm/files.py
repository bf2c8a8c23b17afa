"""Files that tasks write and read themselves, in the folder all executors share.

Each attempt of a task writes a name of its own and only the rows of the attempt
that succeeded list their files, so a lost executor or a second attempt leaves
at most a file that nobody reads.
"""

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def attempt_path(folder: str, suffix: str) -> str:
    """A name in the folder that no other attempt of any task uses."""
    return f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """Stream to a new file."""
    system, path = _place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def stream(uri: str):
    """Stream from a file, its bytes as they are."""
    system, path = _place(uri)
    return system.open_input_stream(path, compression=None)


def mapped(uri: str):
    """Memory map of a file, or where the store has no maps its random-access file."""
    system, path = _place(uri)
    if isinstance(system, pafs.LocalFileSystem):
        return pa.memory_map(path)
    return system.open_input_file(path)
