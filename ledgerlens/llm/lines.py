"""Remove passages that repeat over documents, by content-defined chunks of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.text import set_aside, stored

# Repeated lines in a row are removed if they have so many words together.
MIN_WORDS = 50
# A line is a border with a chance of its words / CHUNK_WORDS, told by a rolling hash.
CHUNK_WORDS = 16
# Up to so many repeated runs, 32 bytes each with their document, are broadcast.
BROADCAST_RUNS = 2_000_000

_MASK = (1 << 64) - 1

RUNS = "doc_id long, text_hash long, first int, last int, run_hash long"


def split_lines(text: str) -> tuple[list[str], list[int]]:
    """All lines of a text, and the numbers of those with a word."""
    lines = text.split("\n")
    return lines, [i for i, line in enumerate(lines) if line and not line.isspace()]


def runs_of(text: str) -> Iterator[tuple[int, int, int]]:
    """First line, last line and hash of each run of lines that is looked up.

    A line is a border if a hash rolled over it and the line before says so, more
    often the more words it has. So a border depends on two lines alone, and all
    borders of a passage but one on its first line are there wherever it stands.
    A chunk goes from a border to the next, both included. The ragged ends of a
    passage are found by the runs that go from each line to the next border
    behind it, and from the last border to each line. Where MIN_WORDS stand in a
    row without a border behind the first line, the shortest runs of so many
    words from each line, and up to each line, are runs as well. So every
    passage of MIN_WORDS is covered by runs that stand wherever it stands. Lines
    without a word are passed over.
    """
    lines, filled = split_lines(text)
    words = [len(lines[i].split()) for i in filled]
    hashes = [xxhash.xxh3_64_intdigest(lines[i]) for i in filled]
    n = len(filled)
    border = [k > 0 and _rolled(hashes[k - 1], hashes[k]) % CHUNK_WORDS < words[k] for k in range(n)]
    # Up to each line: from the last border.
    last = rolled = None
    for k in range(n):
        if border[k]:
            last, rolled = k, hashes[k]
        elif last is not None:
            rolled = _rolled(rolled, hashes[k])
            yield filled[last], filled[k], _sealed(rolled, k - last, 1)
    # From each line: to the next border behind it.
    following = rolled = None
    for k in range(n - 1, -1, -1):
        if following is not None:
            rolled = _rolled(rolled, hashes[k])
            yield filled[k], filled[following], _sealed(rolled, following - k, 2)
        if border[k]:
            following, rolled = k, hashes[k]
    yield from _windows(filled, words, hashes, border)


def _windows(filled: list[int], words: list[int], hashes: list[int], border: list[bool]) -> Iterator[tuple[int, int, int]]:
    """The shortest runs of MIN_WORDS from and up to each line that have no border behind their first line.

    Of runs that overlap and are alike, as where one line stands over and over,
    the first is taken.
    """
    found, start, so_far = set(), 0, 0
    behind = np.concatenate((np.cumsum(border), [0])).tolist() if border else []

    def note(first: int, end: int) -> None:
        if behind[end] == behind[first]:
            found.add((first, end))

    for end in range(len(filled)):
        so_far += words[end]
        if so_far < MIN_WORDS:
            continue
        while so_far - words[start] >= MIN_WORDS:
            note(start, _first_end(words, start))
            so_far -= words[start]
            start += 1
        note(start, end)
        note(start, _first_end(words, start))
    taken: dict[int, int] = {}
    for first, end in sorted(found):
        rolled = hashes[first]
        for h in hashes[first + 1 : end + 1]:
            rolled = _rolled(rolled, h)
        own = _sealed(rolled, end - first, 3)
        if taken.get(own, -1) < first:
            taken[own] = end
            yield filled[first], filled[end], own


def _first_end(words: list[int], start: int) -> int:
    so_far, end = words[start], start
    while so_far < MIN_WORDS:
        end += 1
        so_far += words[end]
    return end


def _rolled(so_far: int, line: int) -> int:
    x = (so_far * 0x9E3779B97F4A7C15 + line + 1) & _MASK
    return x ^ (x >> 29)


def _sealed(rolled: int, length: int, kind: int) -> int:
    """A run's hash: its lines', how many, and how it was found."""
    return _rolled(rolled, 4 * length + kind)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def runs(docs: DataFrame) -> DataFrame:
    """The runs of all documents, a row each, without their text."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts, found, counts = [], [], [], []
            for text in batch["text"]:
                own = list(runs_of(text)) if text else []
                found += own
                counts.append(len(own))
            if not found:
                continue
            first, last, hashes = zip(*found)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64").repeat(counts).to_numpy(),
                    "text_hash": batch["text_hash"].repeat(counts).to_numpy(),
                    "first": np.array(first, "i4"),
                    "last": np.array(last, "i4"),
                    "run_hash": np.array(hashes, "u8").astype("i8"),
                }
            ).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text", _text_hash().alias("text_hash")).mapInPandas(find, RUNS)


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _spelled(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """run_hash and text of the runs' first places."""
    wanted = keepers.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("run_hash", "first", "last")).alias("runs")
    )
    wanted = stored(wanted, "keepers")
    if keepers.count() <= BROADCAST_RUNS:
        wanted = F.broadcast(wanted)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, own in zip(batch["text"], batch["runs"]):
                lines = text.split("\n")
                rows += [(r["run_hash"], "\n".join(lines[r["first"] : r["last"] + 1])) for r in own]
            yield pd.DataFrame(rows, columns=["run_hash", "run_text"])

    keyed = docs.select(F.col("doc_id").cast("long"), "text", _text_hash().alias("text_hash"))
    # Rows that share id and text are one document: its runs are spelled once.
    return (
        keyed.join(wanted, _same_document(keyed, wanted))
        .select("text", "runs")
        .mapInPandas(spell, "run_hash long, run_text string")
        .dropDuplicates(["run_hash"])
    )


def _cut_text(text: str | None, found) -> tuple[str | None, int, int, int]:
    if not text:
        return text, 0, 0, 0
    lines, filled = split_lines(text)
    if not len(found):
        return text, len(lines), 0, 0
    repeated = set()
    for run in found:
        first, last = run["first"], run["last"]
        # The comparison of bytes: runs of one hash may still differ.
        if "\n".join(lines[first : last + 1]) == run["run_text"]:
            repeated.update(range(first, last + 1))
    gone: set[int] = set()
    words, part = 0, []
    for i in [*filled, None]:
        if i is not None and i in repeated:
            part.append(i)
            words += len(lines[i].split())
        else:
            if words >= MIN_WORDS:
                # Blank lines between lines that go, go with them.
                gone.update(range(part[0], part[-1] + 1))
            words, part = 0, []
    if not gone:
        return text, len(lines), 0, 0
    left = [line for i, line in enumerate(lines) if i not in gone]
    lost = sum(len(lines[i].split()) for i in gone)
    return "\n".join(left), len(lines), len(gone), lost


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with cut_text, n_lines, n_removed_lines and n_removed_words.

    A run of lines that stands in several places stays at the first of them, by
    doc_id, text hash and line, and is removed elsewhere, if the lines to go in
    a row have MIN_WORDS together. What is left is joined by line feeds; a text
    of which nothing is left is empty.

    Null texts stay null and empty ones empty. Rows that share id and text are
    one document, whose lines are not repeated by that alone; a null id is the
    least. A long text is handled whole, in one task, and its memory is a few
    times its own size. An empty table gives an empty result. Columns of
    ``docs`` named as the results are replaced, all others kept.
    """
    results = ["cut_text", "n_lines", "n_removed_lines", "n_removed_words"]
    own = [c for c in docs.columns if c not in results]
    found = stored(runs(docs), "runs")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash", "first", "last")
    # Rows of one document and place, from repeated rows, count once.
    repeated = stored(
        found.groupBy("run_hash")
        .agg(F.min(place).alias("keeper"), F.max(place).alias("other"))
        .filter(F.col("keeper") != F.col("other"))
        .select("run_hash", "keeper"),
        "repeated",
    )
    keepers = repeated.select("run_hash", "keeper.doc_id", "keeper.text_hash", "keeper.first", "keeper.last")
    texts = stored(_spelled(docs, keepers), "run-texts")
    hits = (
        found.join(repeated.join(texts, "run_hash"), "run_hash")
        .filter(
            ~(
                F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))
                & (F.col("text_hash") == F.col("keeper.text_hash"))
                & (F.col("first") == F.col("keeper.first"))
            )
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("first", "last", "run_text")).alias("repeated"))
    )
    named = {c: f"l_{i}" for i, c in enumerate(own)}
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in named.items()],
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        _text_hash().alias("text_hash"),
    )

    @F.pandas_udf("cut_text string, n_lines long, n_removed_lines long, n_removed_words long")
    def cut(texts: pd.Series, repeated: pd.Series) -> pd.DataFrame:
        rows = [_cut_text(text, () if found is None else found) for text, found in zip(texts, repeated)]
        return pd.DataFrame(rows, columns=results)

    return (
        keyed.join(hits, _same_document(keyed, hits), "left")
        .withColumn("cut", cut(keyed["text"], F.col("repeated")))
        .select(*[F.col(n).alias(c) for c, n in named.items()], "cut.*")
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its text without repeated passages, and what went."""
    return remove_repeated(docs.select("doc_id", "text")).drop("text").withColumnRenamed("cut_text", "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out; those of which nothing is left go.

    Where there is a column n_chars, it gets the new length.
    """
    renamed, back = set_aside(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    cut = remove_repeated(renamed)
    lost = (F.col("n_removed_lines") > 0) & (F.trim("cut_text") == "")
    new = {"text": F.col("cut_text"), "n_chars": F.length("cut_text").cast("long")}
    return cut.filter(~F.coalesce(lost, F.lit(False))).select(
        *[new[c].alias(c) if c in new else old for c, old in zip(docs.columns, back)]
    )
