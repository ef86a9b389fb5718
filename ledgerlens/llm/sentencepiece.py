"""SentencePiece encoding and decoding by a relational lattice of pieces."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.mapped import map_arrays, write_arrays
from ledgerlens.llm.text import let, stored
from ledgerlens.session import scratch_path

# Fixed value: the character that stands for a space.
SPACE = "▁"
# Units of more characters are merged in Python: a fold's state is one long.
LONGEST = 60
# Up to so many units, some 40 bytes each, are mapped by each worker.
LOADED_UNITS = 100_000_000
# Words that a worker remembers, and texts that it holds at once.
REMEMBERED, SLICE = 200_000, 500

# Fixed value: line feed, tab, vertical tab, form feed. A carriage return is part of some pieces.
BREAKS = "\t\n\x0b\x0c"
_BREAK = re.compile(f"([{BREAKS}])")
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_UNKNOWN = (1 << 20) - 1


@dataclass(frozen=True)
class Model:
    """What a model file holds: (piece, id, score) of the normal pieces, and the first byte piece.

    ``pairs``: the pairs of characters that stand in some piece. Between two
    characters that are no such pair, every encoding has a border.
    """

    pieces: tuple[tuple[str, int, float], ...]
    first_byte: int
    pairs: frozenset[str]

    @classmethod
    def load(cls, path: str) -> Model:
        """Read a BPE model with byte fallback, identity normalisation and a space put before the text."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, first_byte = [], None
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                first_byte = i if first_byte is None else first_byte
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append((model.id_to_piece(i), i, model.get_score(i)))
        if first_byte is None:
            raise ValueError("the model has no byte pieces")
        for piece, _, _ in pieces:
            if re.search(f"[^{SPACE}]{SPACE}|[{BREAKS}].|.[{BREAKS}]", piece, re.S):
                raise ValueError(f"a piece goes beyond a word: {piece!r}")
        pairs = frozenset(p[i : i + 2] for p, _, _ in pieces for i in range(len(p) - 1))
        return cls(tuple(pieces), first_byte, pairs)

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    def bytes_of(self) -> dict[int, bytes]:
        """The bytes of each id."""
        return {i: p.encode() for p, i, _ in self.pieces} | {self.first_byte + b: bytes([b]) for b in range(256)}

    def table(self) -> dict[str, tuple[int, int]]:
        """Rank and id of each piece."""
        ranks = self.ranks()
        return {p: (ranks[s], i) for p, i, s in self.pieces}

    def ranks(self) -> dict[float, int]:
        """Place of each score, the best first; equal scores share one."""
        return {s: i for i, s in enumerate(sorted({s for _, _, s in self.pieces}, reverse=True))}


def words_of(text: str) -> list[str]:
    """The words of a text in order, each with the spaces before it.

    A word is what no piece goes beyond: spaces and what follows up to the next
    one. A line break or tab is a word. The text itself gets a space before it.
    """
    words: list[str] = []
    before = SPACE
    for part in _BREAK.split(text):
        if not part:
            continue
        if part in BREAKS:
            words += [before, part] if before else [part]
        elif "  " in part or SPACE in part or part[-1] == " " or part[0] == " ":
            words += _WORDS.findall(before + part.replace(" ", SPACE))
        else:
            words += (before + part).replace(" ", f" {SPACE}").split(" ")
        before = ""
    return words


def units_of(word: str, pairs: frozenset[str]) -> list[str]:
    """A word, cut between characters that are together in no piece."""
    cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in pairs), len(word)]
    return [word[a:b] for a, b in zip(cuts, cuts[1:])]


class Cutter:
    """`units_of` many words at once."""

    def __init__(self, pairs: frozenset[str]) -> None:
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs) or [-1], np.int64)

    def __call__(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The units of all words in order, and the number of each word's."""
        joined = "".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        pairs = points[:-1] << 21 | points[1:]
        near = self.pairs[np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)]
        cut = np.ones(len(points) + 1, bool)
        cut[1:-1] = near != pairs
        cut[ends] = True
        places = np.flatnonzero(cut)
        bounds = places.tolist()
        units = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        return units, np.diff(np.searchsorted(places, ends), prepend=0)


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, in a row."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def distinct_units(docs: DataFrame, model: Model) -> DataFrame:
    """All distinct units of the texts; ``spelled`` has the ids of those that are too long to fold.

    Dealt by unit into four times the usual partitions, as each unit will be
    exploded into its substrings there.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.pairs, model.table(), model.first_byte))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, table, first_byte = shared.value
        cutter = Cutter(pairs)
        seen: set[str] = set()
        sent: set[str] = set()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                new: set[str] = set()
                for text in batch.slice(at, SLICE).column("text").to_pylist():
                    if text:
                        new.update(words_of(text))
                new -= seen
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen |= new
                units = list(set(cutter(list(new))[0]) - sent) if new else []
                if len(sent) > REMEMBERED:
                    sent.clear()
                sent.update(units)
                spelled = [
                    ",".join(map(str, merge_unit(u, table, first_byte))) if len(u) > LONGEST else None for u in units
                ]
                yield pa.RecordBatch.from_pydict(
                    {"unit": pa.array(units, pa.string()), "spelled": pa.array(spelled, pa.string())}
                )

    found = docs.select("text").mapInArrow(find, "unit string, spelled string")
    return found.repartition(n, "unit", "spelled").distinct()


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """unit, spelled and edges: the pieces in each unit, each packed in a long.

    All substrings up to the longest piece are joined to the pieces, by a hash
    and then by their letters. An edge holds, from the highest bits, the piece's
    rank, first character, end and id; so edges in order are in order of rank,
    then from the left. A character that is no piece has an edge with the id
    _UNKNOWN. The piece table is the model's and is broadcast; the units are
    dealt by unit already, so the edges of one come together without a shuffle.
    Spelled units have no edges.
    """
    spark = units.sparkSession
    ranks = model.ranks()
    hashes = {xxhash.xxh64_intdigest(p, seed=42) for p, _, _ in model.pieces}  # Spark's xxhash64
    if len(hashes) < len(model.pieces):
        raise ValueError("two pieces share a hash")
    pieces = spark.createDataFrame(
        [(p, ranks[s], i) for p, i, s in model.pieces], "spelling string, rank long, id long"
    ).withColumn("key", F.xxhash64("spelling"))
    # Two explodes of plain numbers, as the compiled code of a stage takes them in.
    size, at, n = F.length("unit"), F.col("at"), F.col("n")
    starts = F.when(size <= LONGEST, F.sequence(F.lit(0), size - 1))
    lengths = F.when(at.isNotNull(), F.sequence(F.lit(1), F.least(F.lit(model.longest), size - at)))
    packed = (
        F.shiftleft(F.coalesce("rank", F.lit(_UNKNOWN)).cast("long"), 32)
        + F.shiftleft(at.cast("long"), 26)
        + F.shiftleft((at + n).cast("long"), 20)
        + F.coalesce("id", F.lit(_UNKNOWN))
    )
    same = F.col("spelling") == F.col("piece")
    return (
        units.withColumn("number", F.monotonically_increasing_id())
        .withColumn("at", F.explode_outer(starts))
        .withColumn("n", F.explode_outer(lengths))
        .withColumn("piece", F.col("unit").substr(at + 1, n))
        .withColumn("key", F.xxhash64("piece"))
        .join(F.broadcast(pieces), "key", "left")
        .withColumns({"rank": F.when(same, F.col("rank")), "id": F.when(same, F.col("id"))})
        .filter(F.col("id").isNotNull() | (n == 1) | n.isNull())
        .select("number", "unit", "spelled", F.when(n.isNotNull(), packed).alias("edge"))
        .groupBy("number", "unit", "spelled")
        .agg(F.sort_array(F.collect_list("edge")).alias("edges"))
        .select("unit", "spelled", "edges")
    )


def _at(edge: Column) -> Column:
    return F.shiftright(edge, 26).bitwiseAND(63).cast("int")


def _end(edge: Column) -> Column:
    return F.shiftright(edge, 20).bitwiseAND(63).cast("int")


def _bit(n: Column) -> Column:
    # A shift by a column, as SQL has it.
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _inside(edge: Column) -> Column:
    """The places strictly between an edge's ends, as bits."""
    return _bit(_end(edge)) - _bit(_at(edge) + 1)


def _ends(edge: Column) -> Column:
    return _bit(_at(edge)) + _bit(_end(edge))


def merged_borders(edges: Column, size: Column) -> Column:
    """Borders of a unit's BPE pieces, as bits: a fold over its edges by rank.

    At first all places are borders. An edge whose ends are borders, with one
    more between, joins the two pieces there.
    """

    def step(borders: Column, edge: Column) -> Column:
        ends, inner = _ends(edge), borders.bitwiseAND(_inside(edge))
        fits = (borders.bitwiseAND(ends) == ends) & (F.bit_count(inner) == 1)
        return F.when(fits, borders.bitwiseXOR(inner)).otherwise(borders)

    return F.aggregate(edges, _bit(size + 1) - 1, step)


def best_borders(edges: Column, size: Column) -> Column:
    """Borders of a unit's best path, as bits: a Viterbi fold over its edges by end.

    The score of a path is the sum of its ranks, the least is best; of equal
    ones, that with the longest last piece. For models whose scores add up.
    """
    infinite = 1 << 40

    def step(state: Column, edge: Column) -> Column:
        # state: per place, the least sum and its borders.
        before = F.get(state, _at(edge))
        cost = before["cost"] + F.shiftright(edge, 32)
        end = _end(edge)
        better = cost < F.get(state, end)["cost"]
        changed = F.transform(
            state,
            lambda s, i: F.when(
                i == end, F.struct(cost.alias("cost"), (before["borders"] + _bit(end)).alias("borders"))
            ).otherwise(s),
        )
        return F.when(better, changed).otherwise(state)

    start = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(infinite).cast("long").alias("cost"), F.lit(1).cast("long").alias("borders")
        ),
    )
    by_end = F.array_sort(edges, lambda a, b: F.when(_end(a) != _end(b), _end(a) - _end(b)).otherwise(_at(a) - _at(b)))
    return F.get(F.aggregate(by_end, start, step), size)["borders"]


def _ids(borders: Column, model: Model) -> Column:
    """The ids of the edges between neighbouring borders; bytes for unknown characters."""
    chosen = F.filter(
        "edges",
        lambda e: (borders.bitwiseAND(_ends(e)) == _ends(e)) & (borders.bitwiseAND(_inside(e)) == 0),
    )
    ordered = F.sort_array(F.transform(chosen, lambda e: e.bitwiseAND((1 << 32) - 1)))

    def ids(edge: Column) -> Column:
        spelled = F.hex(F.encode(F.substring(F.col("unit"), _at(edge) + 1, F.lit(1)), "UTF-8"))
        data = F.transform(
            F.sequence(F.lit(0), (F.length(spelled) / 2).cast("int") - 1),
            lambda k: F.conv(F.substring(spelled, 2 * k + 1, F.lit(2)), 16, 10).cast("int") + model.first_byte,
        )
        known = edge.bitwiseAND(_UNKNOWN)
        return F.when(known == _UNKNOWN, data).otherwise(F.array(known.cast("int")))

    return F.flatten(F.transform(ordered, ids))


def merge_unit(unit: str, model_ranks: dict[str, tuple[int, int]], first_byte: int) -> list[int]:
    """The ids of one unit by plain merging: the best rank first, then from the left."""
    import heapq

    text = list(unit)
    left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and right[i] < len(text):
            joined = text[i] + text[right[i]]
            if joined in model_ranks:
                heapq.heappush(heap, (model_ranks[joined][0], i, joined))

    for i in range(len(text)):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = right[i] if text[i] else len(text)
        if j >= len(text) or text[i] + text[j] != joined:
            continue
        text[i], text[j] = joined, ""
        right[i] = right[j]
        if right[j] < len(text):
            left[right[j]] = i
        offer(left[i])
        offer(i)
    ids: list[int] = []
    for piece in text:
        if piece:
            found = model_ranks.get(piece)
            ids += [found[1]] if found else [first_byte + b for b in piece.encode()]
    return ids


def encoded_units(docs: DataFrame, model: Model, borders=merged_borders) -> str:
    """Where the table of unit and ids lies, with all units of the texts."""
    path = scratch_path(docs.sparkSession, "units")
    found = lattice(distinct_units(docs, model), model)
    folded = let(borders(F.col("edges"), F.length("unit")), lambda b: _ids(b, model))
    spelled = F.split("spelled", ",").cast("array<int>")
    ids = F.when(F.col("spelled").isNotNull(), spelled).otherwise(folded)
    found.select("unit", ids.alias("ids")).write.parquet(path)
    return path


def mapped_units(units: DataFrame, width: int) -> tuple[str | None, ...]:
    """Files of the units' hashes, ascending, and their ids, a file per range of hashes.

    The driver gets a path per range.
    """
    spark = units.sparkSession
    folder, shards = scratch_path(spark, "unit-files"), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view("u8")
        lists = table.column("ids").combine_chunks()
        order = np.argsort(keys)
        keys = keys[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two units share a hash")
        ordered = lists.take(pa.array(order))
        ids = ordered.flatten().to_numpy(zero_copy_only=False).astype(f"<u{width}")
        ends = np.cumsum(np.asarray(ordered.value_lengths())).astype("<i8")
        path = write_arrays(folder, [keys, ends, ids])
        return pa.table({"shard": table.column("shard").slice(0, 1), "path": [path]})

    key = F.xxhash64("unit")
    shard = F.shiftrightunsigned(F.shiftrightunsigned(key, 32) * shards, 32).cast("int")
    rows = units.select(key.alias("key"), "ids", shard.alias("shard"))
    found = stored(rows.groupBy("shard").applyInArrow(write, "shard int, path string"), "unit-shards").collect()
    paths = {r["shard"]: r["path"] for r in found}
    return tuple(paths.get(s) for s in range(shards))


class _Units:
    """All units and their ids, in mapped files."""

    def __init__(
        self, paths: tuple[str | None, ...], pairs: frozenset[str], width: int, bytes_of: dict[int, bytes]
    ) -> None:
        self.files = [map_arrays(path) if path else None for path in paths]
        self.cutter, self.width = Cutter(pairs), width
        # What an id is decoded to: bytes in a row, from a start on, so many. A space as such.
        spelled = [bytes_of.get(i, b"").replace(SPACE.encode(), b" ") for i in range(max(bytes_of) + 1)]
        self.lengths = np.array([len(b) for b in spelled])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self._forget()

    def _forget(self) -> None:
        # Each known word's number; by number, the ends of its ids and of its decoded bytes, in a row.
        self.known: dict[str, int] = {}
        self.ids, self.text = np.zeros(0, f"<u{self.width}"), np.zeros(0, np.uint8)
        self.ends = np.zeros((1, 2), "i8")

    def _found(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in a row, and the number of each unit's."""
        keys = np.array([xxhash.xxh64_intdigest(u, seed=42) for u in units], "u8")  # Spark's xxhash64
        shard = ((keys >> np.uint64(32)) * np.uint64(len(self.files)) >> np.uint64(32)).astype("i8")
        starts, lengths, places = np.zeros(len(units), "i8"), np.zeros(len(units), "i8"), []
        for s in np.unique(shard).tolist():
            if self.files[s] is None:
                raise ValueError("a unit of the text is not in the table")
            all_keys, ends, _ = self.files[s]
            mine = np.flatnonzero(shard == s)
            at = np.searchsorted(all_keys, keys[mine])
            if (all_keys[np.minimum(at, len(all_keys) - 1)] != keys[mine]).any():
                raise ValueError("a unit of the text is not in the table")
            starts[mine] = np.where(at > 0, ends[np.maximum(at - 1, 0)], 0)
            lengths[mine] = ends[at] - starts[mine]
            places.append((s, mine))
        out = np.empty(lengths.sum(), f"<u{self.width}")
        first = np.cumsum(lengths) - lengths
        for s, mine in places:
            within = _within(lengths[mine])
            out[np.repeat(first[mine], lengths[mine]) + within] = self.files[s][2][np.repeat(starts[mine], lengths[mine]) + within]
        return out, lengths

    def _learn(self, words: list[str]) -> None:
        units, n_units = self.cutter(words)
        ids, lengths = self._found(units)
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(n_units)]
        sizes = self.lengths[ids]
        text = self.spelled[np.repeat(self.starts[ids], sizes) + _within(sizes)]
        text_ends = np.concatenate(([0], np.cumsum(sizes)))[ends]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.ends = np.concatenate((self.ends, np.stack((ends, text_ends), 1) + self.ends[-1]))
        self.ids, self.text = np.concatenate((self.ids, ids)), np.concatenate((self.text, text))

    def _numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = found < 0
        if missing.any():
            new = set(compress(words, missing.tolist()))
            if len(self.known) + len(new) > REMEMBERED and self.known:
                self._forget()
                return self._numbers(words)
            self._learn(list(new))
            found[missing] = [self.known[w] for w in compress(words, missing.tolist())]
        return found

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in a row and their ends, and the bytes that they are decoded to and their ends."""
        split = [words_of(text) if text else [] for text in texts]
        numbers = self._numbers(list(chain.from_iterable(split)))
        last = np.cumsum([0, *map(len, split)])
        out = []
        for kind, values in enumerate((self.ids, self.text)):
            starts = self.ends[numbers, kind]
            sizes = self.ends[numbers + 1, kind] - starts
            out += [values[np.repeat(starts, sizes) + _within(sizes)], np.concatenate(([0], np.cumsum(sizes)))[last]]
        return tuple(out)


_LOADED: dict[tuple[str | None, ...], _Units] = {}
DIGESTS = ", n_tokens long, ids_crc32 long, decoded_crc32 long"


def encode(
    docs: DataFrame, model: Model, borders=merged_borders, loaded: int = LOADED_UNITS, digests: bool = False
) -> DataFrame:
    """doc_id and ids of each text, one row per row of ``docs``; with ``digests``, also those of `report`.

    Ids are those that the model's library gives, without begin and end. Null
    and empty texts have no ids. Repeated rows are encoded each. Only doc_id and
    text are read, so other columns cannot clash; an empty table gives an empty
    result. A text is cut into units that no piece goes beyond; each distinct
    unit is encoded once, by the lattice.

    Up to ``loaded`` units, the workers map the table of units from the shared
    folder into memory. Beyond that, the units of all texts are joined to it and put
    together again by text.
    """
    spark = docs.sparkSession
    path = encoded_units(docs, model, borders)
    units = spark.read.schema("unit string, ids array<int>").parquet(path)
    keyed = docs.select(F.col("doc_id").cast("long"), "text")
    pairs = spark.sparkContext.broadcast(model.pairs)
    width = 2 if max(i for _, i, _ in model.pieces) < 1 << 16 else 4
    schema = "doc_id long, ids array<int>" + (DIGESTS if digests else "")
    bytes_of = spark.sparkContext.broadcast(model.bytes_of())

    def result(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray, texts: list[bytes] | None) -> pa.RecordBatch:
        columns = [doc_ids, pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(ids.astype("i4")))]
        names = ["doc_id", "ids"]
        if digests:
            wide, bounds = memoryview(ids.astype("<u4")).cast("B"), (4 * ends).tolist()
            columns += [
                pa.array(np.diff(ends), pa.int64()),
                pa.array([zlib.crc32(wide[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                pa.array([zlib.crc32(t) for t in texts], pa.int64()),
            ]
            names += ["n_tokens", "ids_crc32", "decoded_crc32"]
        return pa.RecordBatch.from_arrays(columns, names)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _LOADED:
            _LOADED.clear()
            _LOADED[files] = _Units(files, pairs.value, width, bytes_of.value)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                ids, ends, spelled, stops = _LOADED[files](part.column("text").to_pylist())
                raw, stops = spelled.tobytes(), stops.tolist()
                texts = [raw[a:b].removeprefix(b" ") for a, b in zip(stops, stops[1:])]
                yield result(part.column("doc_id"), ids, ends, texts)
        _LOADED.clear()  # an idle worker would keep its words

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                lists = [ids or [] for ids in part.column("ids").to_pylist()]
                texts = [text_of(ids, bytes_of.value).encode() for ids in lists]
                flat = np.fromiter(chain.from_iterable(lists), "i8", sum(map(len, lists)))
                yield result(part.column("doc_id"), flat, np.cumsum([0, *map(len, lists)]), texts)

    if units.count() <= loaded:
        files = mapped_units(units, width)
        return keyed.mapInArrow(look_up, schema)
    joined = _encode_by_join(keyed, units, pairs)
    return joined.mapInArrow(gathered, schema) if digests else joined


def _encode_by_join(keyed: DataFrame, units: DataFrame, pairs) -> DataFrame:
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                own = [u for w in (words_of(text) if text else []) for u in units_of(w, pairs.value)]
                n = max(1, len(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * n, pa.int64()),
                        pa.array([doc_id] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array(own or [None], pa.string()),
                    ],
                    ["row", "doc_id", "place", "unit"],
                )

    spelled = keyed.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        spell, "row long, doc_id long, place long, unit string"
    )
    placed = F.sort_array(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("place", "ids"))))
    return (
        spelled.join(units, "unit", "left")
        .groupBy("row", "doc_id")
        .agg(F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids"))
        .select("doc_id", "ids")
    )


def text_of(ids: list[int], bytes_of: dict[int, bytes]) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    text = b"".join(map(bytes_of.__getitem__, ids)).decode(errors="replace")
    return text.replace(SPACE, " ").removeprefix(" ")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text of its ids; null ids have an empty one."""
    bytes_of = encoded.sparkSession.sparkContext.broadcast(model.bytes_of())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [text_of(ids or [], bytes_of.value) for ids in part.column("ids").to_pylist()]
                yield part.append_column("text", pa.array(texts, pa.string()))

    return encoded.select("doc_id", "ids").mapInArrow(read, "doc_id long, ids array<int>, text string")


def report(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: its ids, their number and checksum, and the decoded text's checksum."""
    return encode(docs, model, digests=True)
