"""Files of arrays that many workers map into their memory."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs


def write_arrays(folder: str, arrays: list[np.ndarray]) -> str:
    """Arrays in one file, each behind its type and length; a name of its own for each attempt."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    name = f"part-{uuid.uuid4().hex}.trie"
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(np.array([len(arrays)], "<i8").tobytes())
        for a in arrays:
            data = a.tobytes()
            out.write(a.dtype.str.encode().ljust(8) + np.array([a.size, len(data)], "<i8").tobytes())
            out.write(data.ljust(-(-len(data) // 8) * 8, b"\0"))
    return f"{folder}/{name}"


def map_arrays(uri: str) -> list[np.ndarray]:
    """The arrays of a file: mapped into memory, or read into it if the shared folder is no mounted one."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        with store.open_input_file(path) as source:
            data = np.frombuffer(source.read_buffer(), np.uint8)
    at, arrays = 8, []
    for _ in range(int(data[:8].view("<i8")[0])):
        kind = data[at : at + 8].tobytes().strip().decode()
        size, length = data[at + 8 : at + 24].view("<i8").tolist()
        arrays.append(data[at + 24 : at + 24 + length].view(kind)[:size])
        at += 24 + -(-length // 8) * 8
    return arrays
