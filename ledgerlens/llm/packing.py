"""Pack token ids into sequences of one size by Karmarkar-Karp differencing.

A document's ids fill whole windows first. What is left of it, less than a
window, is dealt with that of others into groups of about GROUP tokens, and each
group is partitioned into near-equal windows: single pieces are partial
partitions, and the two most unbalanced ones are merged, the fullest windows of
one with the emptiest of the other, until one partition is left. If its fullest
window exceeds the capacity, the number of windows rises. If that would cost
more than SLACK of the windows, pieces are cut finer and the count starts anew.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.text import stored

WINDOW = 1024
END_ID = 0
# Tokens of a group, each document counting as so many more.
GROUP, PER_PIECE = 1 << 18, 16
# Groups of a task, if there are more than the usual partitions hold.
GROUPS_A_TASK = 32
# Windows more than the least number, as a share, before pieces are cut finer; one more is always allowed.
SLACK = 1 / 128
# Every fourth document of a group is halved again and again, down to so many tokens.
FINE, EVERY = 8, 4

# Fixed value: the pattern that splits text before the merges of a byte-level model.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# How such a model writes bytes: as themselves if they are visible, else as U+0100 and on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {chr(b): b for b in _VISIBLE} | {
    chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)
}


def _ranks(model: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Byte strings by id, and special tokens, of a plain byte-level model; None for any other.

    Plain: the library's own pattern, nothing normalised, no space put before the
    text, and ids in the order of the merges.
    """
    before, merges, vocab = model.get("pre_tokenizer") or {}, model["model"].get("merges"), model["model"].get("vocab")
    special = {t["content"]: t["id"] for t in model.get("added_tokens", []) if t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])}
    plain = (
        model["model"].get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not model.get("normalizer")
        and not model["model"].get("ignore_merges")
        and len(special) == len(model.get("added_tokens", []))
    )
    if not plain:
        return None
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    ids = [vocab[j] for j in joined]
    ranks = {bytes(_BYTE[c] for c in token): i for token, i in vocab.items() if token not in special}
    singles = {i for token, i in ranks.items() if len(token) == 1}
    rising = all(a < b for a, b in zip(ids, ids[1:])) and (not ids or max(singles) < ids[0])
    return (ranks, special) if rising and len(ranks) == 256 + len(ids) else None


class Encoder:
    """ids of texts as 32-bit numbers, by the tokenizer file's content.

    A plain byte-level model is run by the faster of two libraries, from the
    file's own vocabulary; any other by the one that the file is for.
    """

    def __init__(self, model: str) -> None:
        found = _ranks(json.loads(model))
        if found:
            import tiktoken

            ranks, special = found
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.fast, self.library = None, Tokenizer.from_str(model)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model: str) -> Encoder:
    key = zlib.crc32(model.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def id_bytes(model: str, end_id: int = END_ID) -> int:
    """2 if all ids of the tokenizer file fit, else 4."""
    content = json.loads(model)
    vocab = content["model"].get("vocab", {})
    ids = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    return 2 if max([end_id, *ids, *(t["id"] for t in content.get("added_tokens", []))]) < 1 << 16 else 4


def encoded(docs: DataFrame, model: str, end_id: int = END_ID) -> DataFrame:
    """row, doc_id, n_tokens and ids (little-endian, `id_bytes` each) of each row; written once.

    ``row`` numbers the rows; as the table is stored, it stays what it is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = f"<u{id_bytes(model, end_id)}"
    end = np.array([end_id], "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = [np.append(encoder(t), end) if t else end for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(np.arange(row, row + len(part))),
                        "doc_id": part.column("doc_id"),
                        "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                        "ids": pa.array([i.astype(kind).tobytes() for i in ids], pa.binary()),
                    }
                )
                row += len(part)

    schema = "row long, doc_id long, n_tokens long, ids binary"
    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, schema), "encoded")


def differenced(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window (0 to k - 1) of each size, and the windows' sums, the fullest first.

    A partial partition is its windows' sums in descending order, with a node
    each: a size, or two nodes that were joined.
    """
    n = len(sizes)
    parts, heap = {}, []
    for i, size in enumerate(sizes.tolist()):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = size, i
        parts[i] = sums, nodes
        heap.append((-size if k > 1 else 0, i))
    heapq.heapify(heap)
    joined, made = [], n
    for name in range(n, 2 * n - 1):
        (a, a_nodes), (b, b_nodes) = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        sums, b_nodes = a + b[::-1], b_nodes[::-1]
        nodes = np.where(a_nodes < 0, b_nodes, a_nodes)
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        joined.append(np.stack((a_nodes[both], b_nodes[both]), 1))
        nodes[both] = np.arange(made, made + len(both))
        made += len(both)
        order = np.argsort(-sums, kind="stable")
        parts[name] = sums[order], nodes[order]
        heapq.heappush(heap, (int(parts[name][0][-1] - parts[name][0][0]), name))
    sums, nodes = parts[heap[0][1]]
    window = np.full(made, -1, np.int64)
    there = nodes >= 0
    window[nodes[there]] = np.flatnonzero(there)
    children = np.concatenate(joined) if joined else np.zeros((0, 2), np.int64)
    for node in range(made - 1, n - 1, -1):
        window[children[node - n]] = window[node]
    return window[:n], sums


def _halved(size: int) -> list[int]:
    out = []
    while size > FINE:
        out.append(size - size // 2)
        size //= 2
    return [*out, size]


def _cuts(sizes: list[int], level: int, window: int) -> list[list[int]]:
    """Each size in pieces: whole ones at level 0, then finer with each level."""
    if level == 0:
        return [[s] for s in sizes]
    most = max(1, window >> (level - 1))
    return [
        _halved(s) if i % EVERY == 0 else [most] * (s // most) + [s % most] * (s % most > 0)
        for i, s in enumerate(sizes)
    ]


def packed(sizes: list[int], window: int = WINDOW) -> tuple[list[list[int]], list[list[int]], int]:
    """Pieces of each size, the window of each, and the number of windows; sizes are below ``window``."""
    if not sizes:
        return [], [], 0
    least = -(-sum(sizes) // window)
    levels = window.bit_length()
    for level in range(levels):
        pieces = _cuts(sizes, level, window)
        flat = np.array([p for own in pieces for p in own], np.int64)
        k, most = least, least + max(1, int(least * SLACK))
        while k <= most or level == levels - 1:
            found, sums = differenced(flat, k)
            if sums[0] <= window:
                numbers = iter(found.tolist())
                return pieces, [[next(numbers) for _ in own] for own in pieces], k
            k += 1
    raise AssertionError("pieces of one token fit")


def pack(docs: DataFrame, model: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's, little-endian, 32 bits each. Each id of a document,
    the end id included, lies in exactly one piece; pieces of a sequence lie in
    it without gaps, at most ``window`` ids together. Null and empty texts are
    the end id alone, very long ones fill windows of their own first. Repeated
    rows and null ids are documents of their own. Only doc_id and text are
    read, so other columns cannot clash; an empty table gives an empty result.
    Sequence ids are unique, not consecutive: group * 2**32 + number. Groups are
    dealt by a hash of the row's number, so equal documents spread.
    """
    table = encoded(docs, model, end_id)
    lengths = table.select("row", "n_tokens")
    left = F.col("n_tokens") % window
    total = lengths.agg(F.sum(left + PER_PIECE)).first()[0] or 0
    n_groups = -(-total // GROUP)
    group = F.pmod(F.xxhash64("row"), F.lit(max(1, n_groups)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        number = int(rows["group"].iloc[0]) << 32
        out = []
        for row, n in zip(rows["row"].tolist(), rows["n_tokens"].tolist()):
            for start in range(0, n - n % window, window):
                out.append((row, start, window, number, 0))
                number += 1
        rest = rows[rows["n_tokens"] % window > 0]
        pieces, windows, k = packed((rest["n_tokens"] % window).tolist(), window)
        offsets = [0] * k
        for row, n, own, where in zip(rest["row"].tolist(), rest["n_tokens"].tolist(), pieces, windows):
            start = n - n % window
            for length, w in zip(own, where):
                out.append((row, start, length, number + w, offsets[w]))
                offsets[w] += length
                start += length
        return pd.DataFrame(out, columns=["row", "start", "length", "sequence_id", "offset"])

    # A group's work is far more than its bytes tell: a number of tasks of our own.
    n_tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_groups // GROUPS_A_TASK)
    placed = (
        lengths.withColumn("group", group)
        .repartition(n_tasks, "group")
        .groupBy("group")
        .applyInPandas(place, "row long, start long, length long, sequence_id long, offset long")
    )
    width = id_bytes(model, end_id)
    own = F.col("ids").substr((F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int"))
    pieces = placed.join(table, "row").select(
        "doc_id", "start", "length", F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset", own.alias("ids")
    )

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths_ = batch.column("length").to_numpy()
            flat = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}").astype("<u4")
            ends = np.concatenate(([0], np.cumsum(lengths_ * 4))).astype("<i4")
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", ids)

    return pieces if width == 4 else pieces.mapInArrow(widen, pieces.schema)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence, padded to ``window`` unless it has a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ids.alias("ids"))
    size = F.when(F.bit_count("n_tokens") == 1, F.col("n_tokens")).otherwise(window)
    padding = F.lit(np.array([pad_id], "<u4").tobytes() * window)
    missing = F.substring(padding, F.lit(1), ((size - F.col("n_tokens")) * 4).cast("int"))
    return whole.withColumn("ids", F.concat("ids", missing))


def report(docs: DataFrame, model: str) -> DataFrame:
    """The pieces, with a checksum in place of their ids."""
    return pack(docs, model).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
