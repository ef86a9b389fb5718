"""Language-model scores from an n-gram trie of Elias-Fano lists.

The trie has two levels. The first has the words of the training texts, by
hash, with their counts. The second has, for each word, the words that followed
it: per shard an ascending list of contexts, pointers to their ranges, the
successors, made ascending over all ranges, and the smoothed probability of
each, as 16-bit steps of its logarithm. Workers map the files into memory and
ask for successors relative to their context.

Smoothing is by a Dirichlet prior: p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU),
with p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), also for words never seen. A text
begins and ends with the end token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.eliasfano import EliasFano
from ledgerlens.llm.mapped import map_arrays, write_arrays
from ledgerlens.llm.text import stored
from ledgerlens.llm.wordhash import word_hashes
from ledgerlens.session import scratch_path

MU = 100.0
PRIOR = 0.1
# Hash of the end token, which no word has: it stands for a space.
END = np.uint64(0x9E3779B97F4A7C15)
# Tokens that a worker gathers before it counts and sends them on.
GATHERED = 1_000_000
# Training tokens behind a shard of the second level: at most so many keys.
SHARD_TOKENS = 4_000_000
# Steps of log10 p per unit.
STEPS = 4096

_U = np.uint64
BLOCKS = "shard int, keys binary, counts binary"


def _planes(values: np.ndarray) -> bytes:
    """Numbers, compressed byte place by byte place."""
    data = values.view(np.uint8).reshape(len(values), -1).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data)


def _values(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def _blocks(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray) -> pd.DataFrame:
    """A row per shard with its ascending keys, as gaps, and counts."""
    order = np.argsort(shards, kind="stable")
    names, starts = np.unique(shards[order], return_index=True)
    rows = []
    for shard, at in zip(names, np.split(order, starts[1:])):
        gaps = np.diff(keys[at], prepend=_U(0))
        rows.append((int(shard), _planes(gaps.astype("<u8")), _planes(counts[at].astype("<u4"))))
    return pd.DataFrame(rows, columns=["shard", "keys", "counts"])


def _merged(blocks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys of a shard's blocks, and their summed counts."""
    keys = np.concatenate([np.cumsum(_values(k, "<u8"), dtype=np.uint64) for k in blocks["keys"]])
    counts = np.concatenate([_values(c, "<u4") for c in blocks["counts"]]).astype("<i8")
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts[order], starts)


class Words:
    """The first level: ids and counts of words, by hash. Ids go by hash, over the shards."""

    def __init__(self, paths: list[str | None], sizes: list[int]) -> None:
        self.shards = len(paths)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.lists = []
        for path in paths:
            *hashes, counts = map_arrays(path) if path else (*EliasFano.build(np.array([], "u8")).arrays, np.array([0], "<u4"))
            self.lists.append((EliasFano(*hashes), counts))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes, -1 for unknown ones."""
        shard = word_shards(hashes, self.shards)
        out = np.full(len(hashes), -1, np.int64)
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s)
            found = self.lists[s][0].find(hashes[mine] - shard_start(s, self.shards))
            out[mine] = np.where(found >= 0, found + self.first[s], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids; 0 for -1."""
        shard = np.searchsorted(self.first, ids, "right") - 1
        out = np.zeros(len(ids), np.int64)
        for s in np.unique(shard[ids >= 0]):
            mine = np.flatnonzero((shard == s) & (ids >= 0))
            out[mine] = self.lists[s][1][ids[mine] - self.first[s]]
        return out


def word_shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def shard_start(shard: int, shards: int) -> np.uint64:
    return _U(-(-(int(shard) << 32) // shards) << 32)


@dataclass(frozen=True)
class Trie:
    """A trained model: files of both levels, and its sums."""

    words: tuple[tuple[str | None, int], ...]
    pairs: tuple[str | None, ...]
    n_tokens: int
    n_words: int

    def log_word(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + PRIOR) / (self.n_tokens + PRIOR * (self.n_words + 1)))


_OPEN: dict[tuple, Words] = {}
_OPEN_PAIRS: dict[str, tuple] = {}


def _words(files: tuple[tuple[str | None, int], ...]) -> Words:
    if files not in _OPEN:
        _OPEN.clear()
        _OPEN_PAIRS.clear()
        _OPEN[files] = Words([p for p, _ in files], [n for _, n in files])
    return _OPEN[files]


def _tokens(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the texts' tokens, some GATHERED at a time, and the number of each text's."""
    parts, n = [], 0
    for text in texts:
        own = word_hashes(text) if text else np.array([], np.uint64)
        parts.append(np.append(own, END))
        n += len(own) + 1
        if n >= GATHERED:
            yield np.concatenate(parts), np.array([len(p) for p in parts])
            parts, n = [], 0
    if parts:
        yield np.concatenate(parts), np.array([len(p) for p in parts])


def _pair_shards(contexts: np.ndarray, followers: np.ndarray, counts: np.ndarray, shards: int) -> np.ndarray:
    """A pair's shard: that of its context; a context of many tokens is spread over several."""
    parts = 1 + counts // SHARD_TOKENS * 4
    x = (contexts * 0x9E3779B1 + followers % parts * 0x85EBCA77).astype(np.uint64)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return ((x >> _U(33)) % _U(shards)).astype(np.int64)


def train(docs: DataFrame) -> Trie:
    """Count the texts of ``docs`` and write the trie to the shared folder.

    Workers send sorted keys and counts in blocks, one per shard, so that what
    is shuffled is a few bytes per distinct pair of a worker's share. A shard is
    put together by one task, of a size that does not grow with the input. The
    driver gets a row per shard.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "trie")
    n_word_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tokens, _ in _tokens(batch["text"]):
                keys, counts = np.unique(tokens, return_counts=True)
                yield _blocks(keys, counts, word_shards(keys, n_word_shards))

    def write_words(blocks: pd.DataFrame) -> pd.DataFrame:
        shard = int(blocks["shard"].iloc[0])
        keys, counts = _merged(blocks)
        hashes = EliasFano.build(keys - shard_start(shard, n_word_shards))
        path = write_arrays(folder, [*hashes.arrays, counts.astype("<u4")])
        return pd.DataFrame({"shard": [shard], "path": [path], "n": [len(keys)], "tokens": [int(counts.sum())]})

    def by_shard(counter, writer, schema: str, name: str) -> list:
        blocks = docs.select("text").mapInPandas(counter, BLOCKS)
        return stored(blocks.groupBy("shard").applyInPandas(writer, schema), name).collect()

    rows = by_shard(count_words, write_words, "shard int, path string, n long, tokens long", "word-files")
    found = {r["shard"]: r for r in rows}
    files = tuple((found[s]["path"], found[s]["n"]) if s in found else (None, 0) for s in range(n_word_shards))
    n_tokens, n_words = sum(r["tokens"] for r in rows), sum(r["n"] for r in rows)
    if n_words >= 1 << 32:
        raise ValueError("more words than a pair's key can tell")
    bare = Trie(files, (), n_tokens, n_words)
    n_shards = max(n_word_shards, -(-n_tokens // SHARD_TOKENS))
    width = max(1, n_words)

    def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(files)
        end = words.ids(np.array([END]))
        for batch in batches:
            for tokens, _ in _tokens(batch["text"]):
                distinct, place = np.unique(tokens, return_inverse=True)
                ids = words.ids(distinct)[place]
                pairs = np.concatenate((end, ids[:-1])) * width + ids
                keys, counts = np.unique(pairs.astype(np.uint64), return_counts=True)
                contexts, followers = (keys // _U(width)).astype("i8"), (keys % _U(width)).astype("i8")
                yield _blocks(keys, counts, _pair_shards(contexts, followers, words.counts(contexts), n_shards))

    def write_pairs(blocks: pd.DataFrame) -> pd.DataFrame:
        words = _words(files)
        keys, counts = _merged(blocks)
        contexts, followers = (keys // _U(width)).astype("i8"), (keys % _U(width)).astype("i8")
        word = 10 ** bare.log_word(words.counts(followers))
        log = np.log10((counts + MU * word) / (words.counts(contexts) + MU))
        steps = np.clip(np.rint(-log * STEPS), 0, 65_535).astype("<u2")
        own, first = np.unique(contexts, return_index=True)
        place = np.repeat(np.arange(len(own)), np.diff(np.append(first, len(keys))))
        lists = [
            EliasFano.build(own.astype(np.uint64)),
            EliasFano.build(np.append(first, len(keys)).astype(np.uint64)),
            EliasFano.build(place.astype(np.uint64) * _U(width) + followers.astype(np.uint64)),
        ]
        path = write_arrays(folder, [a for x in lists for a in x.arrays] + [steps])
        return pd.DataFrame({"shard": [int(blocks["shard"].iloc[0])], "path": [path]})

    rows = by_shard(count_pairs, write_pairs, "shard int, path string", "pair-files")
    paths = {r["shard"]: r["path"] for r in rows}
    return Trie(files, tuple(paths.get(s) for s in range(n_shards)), n_tokens, n_words)


def _log_pairs(model: Trie, words: Words, contexts: np.ndarray, followers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 p of the stored pairs among these; nan for the others. ``counts``: the contexts'."""
    out = np.full(len(contexts), np.nan)
    shard = _pair_shards(contexts, followers, counts, len(model.pairs))
    order = np.argsort(shard, kind="stable")
    names, starts = np.unique(shard[order], return_index=True)
    for s, at in zip(names, np.split(order, starts[1:])):
        path = model.pairs[s]
        if path is None:
            continue
        if path not in _OPEN_PAIRS:
            arrays = map_arrays(path)
            _OPEN_PAIRS[path] = (*(EliasFano(*arrays[i : i + 4]) for i in (0, 4, 8)), arrays[12])
        known, pointers, successors, steps = _OPEN_PAIRS[path]
        own, back = np.unique(contexts[at], return_inverse=True)
        place = known.find(own.astype(np.uint64))
        there = np.flatnonzero(place >= 0)
        begin, end = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        begin[there] = pointers.get(place[there]).astype("i8")
        end[there] = pointers.get(place[there] + 1).astype("i8")
        asked = np.flatnonzero(place[back] >= 0)
        value = place[back[asked]].astype(np.uint64) * _U(model.n_words) + followers[at[asked]].astype(np.uint64)
        found = successors.find(value)
        # Relative to its context: the place lies in the context's range.
        hit = (found >= begin[back[asked]]) & (found < end[back[asked]])
        out[at[asked[hit]]] = steps[found[hit]] / -STEPS
    return out


def score(docs: DataFrame, model: Trie) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each row of ``docs``.

    base_score sums log10 p(w) over the tokens, score log10 p(w | v). Null and
    empty texts are the end token alone. Repeated rows are scored each. Only
    doc_id and text are read, so other columns cannot clash; an empty table gives an
    empty result. With no training text, no word is known.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(model.words)
        end = words.ids(np.array([END]))
        width = max(1, model.n_words)
        for batch in batches:
            done = []
            for tokens, sizes in _tokens(batch["text"]):
                starts = np.cumsum(sizes) - sizes
                distinct, place = np.unique(tokens, return_inverse=True)
                ids = words.ids(distinct)
                counts = words.counts(ids)
                log_word = model.log_word(counts) if model.n_words else np.zeros(len(counts))
                base, known = log_word[place], counts[place] > 0
                ids = ids[place]
                before = np.concatenate((end, ids[:-1]))
                of_before = np.concatenate((words.counts(end), counts[place][:-1]))
                log = base + np.log10(MU / (of_before + MU))
                both = np.flatnonzero((ids >= 0) & (before >= 0))
                pairs, back = np.unique(before[both].astype(np.uint64) * _U(width) + ids[both].astype(np.uint64), return_inverse=True)
                contexts = (pairs // _U(width)).astype("i8")
                stored_log = _log_pairs(model, words, contexts, (pairs % _U(width)).astype("i8"), words.counts(contexts))[back]
                log[both] = np.where(np.isnan(stored_log), log[both], stored_log)
                done.append(
                    np.stack([sizes, np.add.reduceat(known, starts, dtype=np.int64), np.add.reduceat(base, starts), np.add.reduceat(log, starts)])
                )
            sums = np.concatenate(done, axis=1) if done else np.zeros((4, 0))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64").to_numpy(),
                    "n_tokens": sums[0].astype("i8"),
                    "n_known": sums[1].astype("i8"),
                    "base_score": sums[2],
                    "score": sums[3],
                }
            ).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        read, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


def report(docs: DataFrame, held_out: int = 0, folds: int = 10) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(doc_id) % folds is not ``held_out``.

    A null id counts as an empty text there.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
    model = train(docs.filter(fold != held_out))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
