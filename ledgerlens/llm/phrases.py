"""Collocations: phrases of two to four words, by how strongly their parts stick together.

Three passes over the texts. The first counts words. The second makes
Misra-Gries summaries of the n-grams of frequent words: a row per worker's share
and hash partition, merged per partition with a capacity above the partition's
mass divided by the threshold, so that no frequent n-gram can get lost. The
third counts the occurrences of all n-grams that may be frequent, exactly, by
their words.

What stands between the passes is a bit map of the hashes that may be frequent.
It is bounded by MAP_BITS; two n-grams that share a bit cost work and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import ipc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.text import stored

# A phrase is frequent from so many occurrences on; of how many words it may be.
THRESHOLD, LONGEST = 30, 4
# A phrase goes if a longer one holds so many per cent of its occurrences.
COVERED = 80
SCALE = 2_000_000
# Fixed value: the language of texts that have none.
NO_LANG = "und"
TOP = 2000
# A bit map has so many bits per n-gram that may be frequent, and at most so many.
BITS_EACH, MAP_BITS = 32, 1 << 28
# Words that a worker gathers before it counts and sends them on.
GATHERED = 1_000_000
# Rows of counts that a worker sums up before it sends them on.
HELD_ROWS = 1_000_000
# Bytes of a text that are cut into words at once.
SLICE = 1 << 22
# Mass behind a hash partition.
PARTITION_MASS = 1 << 25
# Entries that a partition takes in before it merges them.
TAKEN_IN = 1 << 21

# A-Z in lower case; signs and line ends that end a piece, as a byte that no text has; tab as space.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_MARK = b"\xff"
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + _MARK * len(_ENDS) + b" "
)
_SPACED = b" " + _MARK + b" "
_U = np.uint64
# Bits of an n-gram's hash that a summary holds.
_KEPT = _U(0xFFFFFFFFFFFF0000)
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))


def tokens_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some SLICE bytes at a time, with a mark wherever a piece ends, also behind the last.

    A slice ends with a piece. Between spaces there are empty words.
    """
    data = text.encode().translate(_TABLE)
    start = 0
    while start <= len(data):
        end = data.find(_MARK, start + SLICE)
        end = len(data) if end < 0 else end
        yield [*data[start:end].replace(_MARK, _SPACED).split(b" "), _MARK]
        start = end + 1


class _Ids(dict):
    """Numbers of the words of one language, shared with other languages' words."""

    def __init__(self, lang: str, block: Block) -> None:
        super().__init__({b"": -1, _MARK: 0})
        self.lang, self.block = lang, block

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self.block.words)
        self.block.words.append(word)
        self.block.langs.append(self.lang)
        return found


class Block:
    """Numbered words of some texts in order, 0 where a piece ends. Words of two languages never share a number."""

    def __init__(self) -> None:
        self.words, self.langs = [_MARK], [""]
        self.by_lang: dict[str, _Ids] = {}
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        ids = self.by_lang.get(lang)
        if ids is None:
            ids = self.by_lang[lang] = _Ids(lang, self)
        found = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
        found = found[found >= 0]
        self.parts.append(found)
        self.n += len(found)

    @property
    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash, not 0, of each numbered word and its language; 0 for the end of a piece."""
        seeds = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in self.by_lang}
        found = map(xxhash.xxh3_64_intdigest, self.words, (seeds.get(lang, 0) for lang in self.langs))
        hashes = np.fromiter(found, np.uint64, len(self.words)) | _U(1)
        hashes[0] = 0
        return hashes


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of some GATHERED words of batches with ``lang`` and ``text``."""
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for words in tokens_of(text):
                block.add(lang, words)
                if block.n >= GATHERED:
                    yield block
                    block = Block()
    if block.n:
        yield block


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of what the left and the right one stand for, in a row."""
    x = left * _MIX[0] + right
    x ^= x >> _U(29)
    x *= _MIX[1]
    x ^= x >> _U(32)
    return x


def n_grams(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, places and hashes of the n-grams of two words or more in a row of word hashes; 0 parts them."""
    places = np.flatnonzero(hashes)
    own = hashes[places]
    for size in range(2, LONGEST + 1):
        inside = places + size - 1 < len(hashes)
        places, own = places[inside], own[inside]
        last = hashes[places + size - 1]
        there = last != 0
        places = places[there]
        own = _joined(own[there], last[there])
        yield size, places, own


class BitMap:
    """Whether a hash may be among those it was made of."""

    def __init__(self, bits: np.ndarray, log_bits: int) -> None:
        self.bits, self.shift = bits, _U(64 - log_bits)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def bit_map(hashes: DataFrame, n: int) -> Broadcast:
    """A broadcast map of the longs in column ``hash``; ``n`` or so are expected. Of MAP_BITS at most.

    Spark's bitmap aggregate makes it, 4 KB per 32,768 bits; those rows come to the driver.
    """
    log_bits = min(max(15, (max(1, n) * BITS_EACH).bit_length()), MAP_BITS.bit_length() - 1)
    # Bits are told from 0 on, the function's buckets and places from 1 on.
    bit = F.shiftrightunsigned("hash", 64 - log_bits) + 1
    rows = (
        hashes.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    bits = np.zeros(1 << (log_bits - 3), np.uint8)
    for row in rows.collect():
        start = (row["bucket"] - 1) * 4096
        part = np.frombuffer(row["bits"], np.uint8)[: len(bits) - start]
        bits[start : start + len(part)] = part
    return hashes.sparkSession.sparkContext.broadcast(BitMap(bits, log_bits))


class Sums:
    """Sums of a count ``n`` over equal values of the other columns, in batches; holds some HELD_ROWS rows, or twice as many."""

    def __init__(self) -> None:
        self.held: list[pa.RecordBatch] = []
        self.n = 0

    def add(self, batch: pa.RecordBatch) -> bool:
        """Whether so much has come together that it should be taken."""
        self.held.append(batch)
        self.n += len(batch)
        if self.n >= 2 * HELD_ROWS:
            self.held = self._table().to_batches()
            self.n = sum(map(len, self.held))
        return self.n >= HELD_ROWS and len(self.held) == 1

    def _table(self) -> pa.Table:
        table = pa.Table.from_batches(self.held)
        keys = [c for c in table.column_names if c != "n"]
        return table.group_by(keys).aggregate([("n", "sum")]).select([*keys, "n_sum"]).rename_columns([*keys, "n"]).combine_chunks()

    def take(self) -> pa.Table:
        table = self._table()
        self.held, self.n = [], 0
        return table


def summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """What a worker's blocks have in common, once."""
    sums = Sums()
    for batch in batches:
        if sums.add(batch):
            yield sums.take()
    if sums.held:
        yield sums.take()


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, hash and n of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = np.bincount(block.ids, minlength=len(block.words))[1:]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(block.langs[1:], pa.string()),
                    "word": pa.array([w.decode() for w in block.words[1:]], pa.string()),
                    "hash": block.hashes()[1:].view("i8"),
                    "n": n,
                }
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in summed_counts(count(batches)):
            yield from table.to_batches()

    found = docs.mapInArrow(summed, "lang string, word string, hash long, n long")
    return stored(found.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "words")


def _packed(values: np.ndarray) -> bytes:
    """Numbers, compressed byte place by byte place."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct hashes and their summed counts."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


class Summary:
    """A Misra-Gries summary: at most ``capacity`` hashes, their counters, and what was taken off each.

    A hash of f occurrences has a counter of f - off at least. With a capacity
    above mass / threshold less one, ``off`` stays below the threshold.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.off = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = _summed(np.concatenate((self.hashes, hashes)), np.concatenate((self.counts, counts)))
        if len(self.counts) > self.capacity:
            least = len(self.counts) - self.capacity - 1
            off = int(np.partition(self.counts, least)[least])
            left = self.counts > off
            self.hashes, self.counts = self.hashes[left], self.counts[left] - off
            self.off += off

    def possible(self, threshold: int) -> np.ndarray:
        """All hashes that may occur ``threshold`` times."""
        return self.hashes[self.counts + self.off >= threshold]


def summaries(docs: DataFrame, words: Broadcast, n_partitions: int) -> DataFrame:
    """partition, mass, hashes and counts: a row per block of a worker and hash partition.

    Only words in the map ``words`` count; others end a piece.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([-(-(p << 32) // n_partitions) << 32 for p in range(n_partitions)], np.uint64)
        for block in blocks(batches):
            own = block.hashes()
            own[~words.value(own)] = 0
            found = np.concatenate([h for _, _, h in n_grams(own[block.ids])])
            # The lower bits are dropped: shorter on the way, and two that meet only add up.
            hashes, counts = np.unique(found & _KEPT, return_counts=True)
            cuts = np.append(np.searchsorted(hashes, edges), len(hashes))
            rows = []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[p], cuts[p + 1])
                gaps = np.diff(hashes[part] >> _U(16), prepend=_U(0))
                rows.append((p, int(counts[part].sum()), _packed(gaps), _packed(counts[part].astype("<u4"))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["partition", "mass", "hashes", "counts"])

    return docs.mapInArrow(summarise, "partition long, mass long, hashes binary, counts binary")


def possible_n_grams(parts: DataFrame, n_partitions: int, threshold: int) -> DataFrame:
    """Column ``hash``: of `summaries`, the n-grams that may occur ``threshold`` times, less their lower bits.

    A task reads its partitions' rows one after the other, and holds the
    summary of one.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, summary, taken, n = None, None, [], 0

        def take_in() -> None:
            nonlocal taken, n
            if taken:
                summary.merge(*(np.concatenate(x) for x in zip(*taken)))
            taken, n = [], 0

        def result() -> pa.RecordBatch:
            take_in()
            return pa.RecordBatch.from_pydict({"hash": summary.possible(threshold).view("i8")})

        for batch in batches:
            for own, mass, packed, counts in zip(*(batch.column(c) for c in ("partition", "all_mass", "hashes", "counts"))):
                if own.as_py() != partition:
                    if summary:
                        yield result()
                    partition, summary = own.as_py(), Summary(mass.as_py() // threshold + 1)
                hashes = np.cumsum(_unpacked(packed.as_py(), "<u8"), dtype=np.uint64) << _U(16)
                taken.append((hashes, _unpacked(counts.as_py(), "<u4").astype("<i8")))
                n += len(hashes)
                if n >= TAKEN_IN:
                    take_in()
        if summary:
            yield result()

    mass = F.sum("mass").over(Window.partitionBy("partition"))
    # As many tasks as partitions, which grow with the mass.
    dealt = parts.repartition(n_partitions, "partition")
    return dealt.withColumn("all_mass", mass).mapInArrow(merge, "hash long")


def counted(docs: DataFrame, words: Broadcast, possible: Broadcast, n_partitions: int, threshold: int) -> DataFrame:
    """lang, phrase, size and n: exact counts of all frequent n-grams of two words or more.

    Those that are in both maps are counted. A worker numbers the n-grams of a
    block, the longer by the shorter one that they begin with, so that equal
    numbers mean equal words, and sends its sums as compressed tables, one to a
    hash partition, where they are added up by their words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            own = block.hashes()
            own[~words.value(own)] = 0
            ids = block.ids
            words_ = [w.decode(errors="replace") for w in block.words]
            # names: of the n-grams that the longer ones are numbered by.
            names, known = words_, ids.astype(np.int64)
            for size, places, hashes in n_grams(own[ids]):
                there = possible.value(hashes & _KEPT) & (known[places] >= 0)
                places, hashes = places[there], hashes[there]
                keys, first, number, n = np.unique(
                    known[places] << 32 | ids[places + size - 1], return_index=True, return_inverse=True, return_counts=True
                )
                names = [f"{names[key >> 32]} {words_[key & 0xFFFFFFFF]}" for key in keys.tolist()]
                known = np.full(len(ids), -1, np.int64)
                known[places] = number
                langs = [block.langs[i] for i in ids[places[first]].tolist()]
                partition = (hashes[first] >> _U(32)) * _U(n_partitions) >> _U(32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "partition": partition.astype("i8"),
                        "lang": pa.array(langs, pa.string()),
                        "phrase": pa.array(names, pa.string()),
                        "size": np.full(len(n), size, "i4"),
                        "n": n,
                    }
                )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = ipc.IpcWriteOptions(compression="zstd")
        for table in summed_counts(count(batches)):
            table = table.sort_by([("partition", "ascending"), ("phrase", "ascending")])
            own = table.column("partition").to_numpy()
            names, starts = np.unique(own, return_index=True)
            packed = []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(own)]):
                out = pa.BufferOutputStream()
                with ipc.new_stream(out, table.schema, options=options) as writer:
                    writer.write_table(table.slice(start, end - start))
                packed.append(out.getvalue().to_pybytes())
            yield pa.RecordBatch.from_pydict({"partition": names, "sums": pa.array(packed, pa.binary())})

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sums = None, Sums()

        def result() -> Iterator[pa.RecordBatch]:
            table = sums.take()
            yield from table.filter(pc.field("n") >= threshold).drop_columns("partition").to_batches()

        for batch in batches:
            for own, packed in zip(batch.column("partition").to_pylist(), batch.column("sums")):
                if own != partition and sums.held:
                    yield from result()
                partition = own
                for part in ipc.open_stream(packed.as_buffer()):
                    sums.add(part)
        if sums.held:
            yield from result()

    sent = docs.mapInArrow(send, "partition long, sums binary")
    dealt = sent.repartition(n_partitions, "partition").sortWithinPartitions("partition")
    return dealt.mapInArrow(add_up, "lang string, phrase string, size int, n long")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases of one to LONGEST words (lang, phrase, size, n), and each language's words (lang, n)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts = word_counts(texts)
    frequent = counts.filter(F.col("n") >= threshold)
    n_words, mass = frequent.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    mass *= LONGEST - 1
    words = bit_map(frequent, n_words)
    n_partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass // PARTITION_MASS))
    parts = summaries(texts, words, n_partitions)
    possible = bit_map(possible_n_grams(parts, n_partitions, threshold), mass // threshold)
    longer = counted(texts, words, possible, n_partitions, threshold)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")
    return stored(single.unionByName(longer), "phrases"), counts.groupBy("lang").agg(F.sum("n").alias("n"))


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Words and phrases are those of one language; a null one is NO_LANG. ``a`` is
    a phrase's count, ``l`` and ``r`` those of its parts at the cut of lowest
    score, floor(SCALE * a / (l + r)), ties to the first cut; ``n`` counts all of the
    language's words. Phrases that a longer one holds COVERED per cent of go.
    Order: score and a descending, phrase ascending. Null and empty texts have
    no words, very long ones are cut into words slice by slice, repeated rows
    count each. Only lang and text are read, so other columns cannot clash; an
    empty table gives an empty result.
    """
    found, totals = frequent_phrases(docs, threshold)
    candidates = found.filter(F.col("size") > 1).withColumn("words", F.split("phrase", " "))
    sizes = F.col("size")

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), sizes - 1),
            lambda k: F.transform(F.sequence(F.lit(1), sizes - k + 1), lambda at: _part(at, k)),
        )
    )
    longer = (
        candidates.filter(sizes > 2)
        .select("lang", F.explode(inner).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(COVERED) * F.col("n"))
    )

    counts = found.select("lang", "phrase", "n")
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), sizes - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, sizes - F.col("k")).alias("right")
    )
    scored = cuts.join(counts.toDF("lang", "left", "l"), ["lang", "left"]).join(counts.toDF("lang", "right", "r"), ["lang", "right"])
    # As decimals, so that no product passes its type.
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # Ranks are limited before the shuffle: a language's window sees ``top`` rows of each task.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
