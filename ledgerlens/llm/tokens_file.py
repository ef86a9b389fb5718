"""Token ids in length-delimited binary records, with an index for shuffled reads.

A data file is a run of records. Each is
    length of the payload      unsigned 64 bit, little endian
    masked checksum of it      unsigned 32 bit, little endian
    payload
    masked checksum of it      unsigned 32 bit, little endian
The checksum is a CRC-32, rotated right by 15 bits and raised by a constant, so
that a checksum of data that hold checksums stays meaningful. The payload is
the ids, two bytes each if the vocabulary allows it and else four.

The index file beside it has one fixed-size entry a record, so record k is found
by one seek: document id, whether the id is null, offset of the record, ids.

Every attempt of a task writes files of its own. Those that count are named in
the manifest, which Spark commits; what a lost attempt left is in no manifest.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm.text import stored
from ledgerlens.session import scratch_path

END_ID = 2
# Words, and parts of words, whose ids a worker remembers.
REMEMBERED = 250_000

# Signs up to U+024F, but for the white space among them.
_PLAIN = re.compile("[^\x00-\x20\x85\xa0\u0250-\U0010ffff]+")
_PART = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_SIGNS = ".,;:!?"
_LENGTH, _CHECK = np.dtype("<u8"), np.dtype("<u4")
_ENTRY = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("offset", "<u8"), ("n_tokens", "<u8")])
_MASK = 0xA282EAD8

# How the tokenizer writes bytes: as themselves if they are visible, else as U+0100 and on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

MANIFEST = "shard int, path string, width int, n_records long, n_tokens long"


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join(
        (
            length,
            masked_checksum(length).to_bytes(4, "little"),
            payload,
            masked_checksum(payload).to_bytes(4, "little"),
        )
    )


def read_record(file) -> bytes:
    """The payload of the record at the file's position; fails if a checksum differs."""
    head = file.read(12)
    length = head[:8]
    if len(head) < 12 or masked_checksum(length) != int.from_bytes(head[8:], "little"):
        raise ValueError("a record's length is damaged")
    size = int.from_bytes(length, "little")
    payload, check = file.read(size), file.read(4)
    if len(payload) < size or masked_checksum(payload) != int.from_bytes(check, "little"):
        raise ValueError("a record's ids are damaged")
    return payload


class Remembered(dict):
    """What was found for keys, of the last ``most`` keys at least and twice as many at most."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.old = most, {}

    def missing(self, keys: set[bytes]) -> list[bytes]:
        """The keys that must be found; afterwards those of before are at hand again."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        unknown = []
        for key in keys:
            if key not in self:
                found = self.old.get(key)
                if found is None:
                    unknown.append(key)
                else:
                    self[key] = found
        return unknown


class _Encoder:
    """Encodes words with the library, each once as long as it is remembered.

    The tokenizer drops white space and lets no token cross it, so the ids of a
    text are those of its words in a row. It cuts a word into runs of letters,
    single digits and runs of other signs, in lower case, and lets no token
    cross those either: of a plain word, the library encodes the parts. A word
    is plain if it is of letters whose lower case does not depend on others,
    and holds no special token.
    """

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.model = self.tokenizer.model
        self.words, self.parts = Remembered(REMEMBERED), Remembered(REMEMBERED)
        self.end = END_ID.to_bytes(self.width, "little")
        self.written = [i.to_bytes(self.width, "little") for i in range(size)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in found]

    def _learn(self, words: list[bytes]) -> None:
        plain, other = [], []
        for raw in words:
            word = raw.decode()
            if _PLAIN.fullmatch(word) and "<|" not in word:
                word = word.lower()
                # Letters, with a sign behind them or not, need no search for the parts.
                if word.isalpha():
                    plain.append((raw, (word,)))
                elif word[-1] in _SIGNS and word[:-1].isalpha():
                    plain.append((raw, (word[:-1], word[-1])))
                else:
                    plain.append((raw, _PART.findall(word)))
            else:
                other.append((raw, word))
        written = self.written
        for part in self.parts.missing({p for _, own in plain for p in own}):
            # A part is one step of the tokenizer, its model's: bytes to ids.
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES)
            self.parts[part] = b"".join([written[t.id] for t in self.model.tokenize(spelled)])
        for raw, own in plain:
            self.words[raw] = self.parts[own[0]] if len(own) == 1 else b"".join([self.parts[p] for p in own])
        if other:
            self.words.update(zip([raw for raw, _ in other], self._encode([word for _, word in other])))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 10):
            # Words end at ASCII white space, as those of bytes do.
            split = [text.encode().split() for text in texts[at : at + 10]]
            found = [list(map(self.words.get, words)) for words in split]
            unknown = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
            if unknown and (new := self.words.missing(unknown)):
                self._learn(new)
            for words, ids in zip(split, found):
                # What was at hand is kept in ``ids``, as learning may have put it among the old.
                if None in ids:
                    ids = [self.words[w] if i is None else i for w, i in zip(words, ids)]
                yield b"".join(ids) + self.end

    def forget(self) -> None:
        """Keep only the later words: idle workers keep their memory, next to others at work."""
        for found in (self.words, self.parts):
            found.old = {}


_ENCODERS: dict[int, _Encoder] = {}


def _encoder(model: str) -> _Encoder:
    key = zlib.crc32(model.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = _Encoder(model)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, model: str, path: str) -> DataFrame:
    """Encode ``docs`` into files under ``path``; returns the manifest, a row per shard.

    ``model`` is the tokenizer file's content. Documents are in ascending order
    of doc_id, over the shards and in each; null ids come first, and documents
    of one id are in the order of their text's hash. Null and empty texts
    are records of the end id alone. Only doc_id and text are read, so other columns
    cannot clash; an empty table has an empty manifest.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared.value)
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{uuid.uuid4().hex}"
        entries, offset, tokens = [], 0, 0
        with store.open_output_stream(f"{folder}/{name}.bin") as data, store.open_output_stream(
            f"{folder}/{name}.idx"
        ) as index:
            n = 0
            for batch in batches:
                for doc_id, ids in zip(batch["doc_id"], encoder(batch["text"].tolist())):
                    record = framed(ids)
                    data.write(record)
                    count = len(ids) // encoder.width
                    no_id = pd.isna(doc_id)
                    entries.append((0 if no_id else doc_id, no_id, offset, count))
                    offset += len(record)
                    tokens += count
                n += len(entries)
                index.write(np.array(entries, _ENTRY).tobytes())
                entries = []
        encoder.forget()
        if n:
            yield pd.DataFrame(
                {"shard": [shard], "path": [f"{path}/{name}"], "width": [encoder.width], "n_records": [n], "n_tokens": [tokens]}
            )
        else:
            store.delete_file(f"{folder}/{name}.bin")
            store.delete_file(f"{folder}/{name}.idx")

    # Rows of one id are told apart by their text and the part they come from,
    # so that even such rows spread over shards.
    keys = ["doc_id", "t_hash", "t_part"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumns({"t_hash": F.xxhash64("text"), "t_part": F.spark_partition_id()})
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
    )
    manifest = ordered.select("doc_id", "text").mapInPandas(write, MANIFEST)
    return stored(manifest, "manifest")


def read_index(manifest: DataFrame) -> DataFrame:
    """A row per record: shard, place in the shard, path, width, doc_id, offset, n_tokens."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                store, file = fs.FileSystem.from_uri(f"{row.path}.idx")
                with store.open_input_file(file) as index:
                    first = 0
                    while part := index.read(_ENTRY.itemsize * 65_536):
                        entries = np.frombuffer(part, _ENTRY)
                        yield pd.DataFrame(
                            {
                                "shard": row.shard,
                                "place": np.arange(first, first + len(entries)),
                                "path": row.path,
                                "width": row.width,
                                "doc_id": pd.array(entries["doc_id"], "Int64").copy(),
                                "no_id": entries["no_id"].astype(bool),
                                "offset": entries["offset"].astype("i8"),
                                "n_tokens": entries["n_tokens"].astype("i8"),
                            }
                        )
                        first += len(entries)

    entries = _spread(manifest).mapInPandas(
        read,
        "shard int, place long, path string, width int, doc_id long, no_id boolean, offset long, n_tokens long",
    )
    return entries.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def _spread(manifest: DataFrame) -> DataFrame:
    """One shard a task, or a few: a shard's file is read in one go."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "shard")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """All records in file order: shard, doc_id, in_shard, n_tokens, ids_crc32.

    ``in_shard``: ids of the shard's earlier records. Checksums are verified, and
    the index is held against the data.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                store, file = fs.FileSystem.from_uri(row.path)
                rows, before = [], 0
                with store.open_input_stream(f"{file}.idx") as index, store.open_input_stream(
                    f"{file}.bin", buffer_size=1 << 20
                ) as data:
                    at = 0
                    while entry := index.read(_ENTRY.itemsize):
                        doc_id, no_id, offset, n = np.frombuffer(entry, _ENTRY)[0].item()
                        payload = read_record(data)
                        ids = np.frombuffer(payload, f"<u{row.width}")
                        if offset != at or n != len(ids):
                            raise ValueError(f"{row.path}: the index does not fit the data")
                        at += len(payload) + 16
                        rows.append((row.shard, None if no_id else doc_id, before, n, zlib.crc32(ids.astype("<u4").tobytes())))
                        before += n
                        if len(rows) == 10_000:
                            yield _records(rows)
                            rows = []
                if rows:
                    yield _records(rows)

    return _spread(manifest).mapInPandas(
        read, "shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long"
    )


def _records(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"])
    return frame.astype({"doc_id": "Int64"})


def shuffled_tokens(manifest: DataFrame, seed: int) -> DataFrame:
    """doc_id and ids of all records in a random order, the same for one seed.

    Only the index is shuffled; each record is then read at its offset.
    """

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            files, ids = {}, []
            for row in batch.itertuples():
                if row.path not in files:
                    store, file = fs.FileSystem.from_uri(f"{row.path}.bin")
                    files[row.path] = store.open_input_file(file)
                files[row.path].seek(row.offset)
                ids.append(np.frombuffer(read_record(files[row.path]), f"<u{row.width}").astype("i8"))
            for file in files.values():
                file.close()
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    order = F.xxhash64(F.lit(seed), "shard", "place")
    return (
        read_index(manifest)
        .withColumn("order", order)
        .repartitionByRange("order")
        .sortWithinPartitions("order")
        .mapInPandas(fetch, "doc_id long, ids array<long>")
    )


def report(docs: DataFrame, model: str) -> DataFrame:
    """One row per document, read back from the files: place among all ids, ids, checksum."""
    manifest = write_tokens(docs, model, scratch_path(docs.sparkSession, "tokens"))
    # One row per shard: a bounded window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return read_tokens(manifest).join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def model_text(path: str) -> str:
    """A tokenizer file's content; the file is the driver's."""
    with open(path, encoding="utf-8") as file:
        return file.read()
