"""Near-duplicates by MinHash and an LSH forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.text import set_aside, stored
from ledgerlens.llm.wordhash import forget, word_hashes

# Trees of the forest, and hash values of a tree's key.
TREES, DEPTH = 16, 6
# Neighbours share this many leading values at least: a pair of similarity 0.8
# does so in none of the trees with a chance of (1 - 0.8**2)**16 = 8e-8.
MIN_DEPTH = 2
# Of a region with more members, a longer prefix is asked for.
REGION = 32
# Where even whole keys don't part a region, each member meets this many next ones.
NEXT = 2
# Trees whose nearest neighbours are compared first.
FIRST_TREES = 4
# Classes of a block: pairs of blocks are a task's work where a region is crowded.
BLOCK, SET_BLOCK = 2048, 512
# Rows of a pair of blocks, pairs of rows, and shingles that are compared at once.
STRIP, PAIRS_AT_ONCE, COLUMNS = 128, 8192, 2048
# Up to so many rows of ids, 16 bytes each, are broadcast to thin or to mark a table.
BROADCAST_IDS = 4_000_000

# Bytes of a shingle's hash that are kept: two different shingles of two texts
# of 1,000 words each share one with a chance below 1e-8.
_KEPT = 6

_random = np.random.default_rng(20_240_601)
_A = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)

# A pair whose sketches, one bit a hash value, agree in fewer bits is no candidate.
# At similarity 0.8 a bit agrees with a chance of 0.9, and this lies six standard
# deviations below what is expected: by the binomial tail 1.4e-7 of such pairs go.
SKETCH_DEVIATIONS = 6
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# Bits of a set's parity: four a shingle, as a power of two.
LEAST_BITS, MOST_BITS = 1 << 8, 1 << 17

SETS = "doc_id long, n_shingles long, set_id binary, shingles binary, keys binary, sketch binary, parity binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct ``size``-word shingles, ascending; of all words if there are fewer."""
    hashes = word_hashes(text)
    if not len(hashes):
        return np.array([], np.uint64)
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return np.unique(out >> np.uint64(64 - 8 * _KEPT))


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEPT].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _KEPT, 8), np.uint8)
    out[:, :_KEPT] = np.frombuffer(data, np.uint8).reshape(-1, _KEPT)
    return out.view("<u8").ravel()


def _keys(values: np.ndarray) -> tuple[bytes, bytes]:
    """The forest's keys of a set: per tree DEPTH minima, two bytes each, first the
    leading one. And its sketch: another bit of each."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        part = _mix(values[at : at + 4096, None] * _A + _B)
        least = np.minimum(least, part.min(axis=0))
    keys = (least & np.uint64(0xFFFF)).astype(">u2").tobytes()
    return keys, np.packbits((least >> np.uint64(16)).astype(np.uint8) & 1).tobytes()


def _parity(values: np.ndarray) -> bytes:
    """For each remainder of the hashes, whether an odd number of shingles has it.

    Where the parities of two sets differ, a shingle is in one of them alone. So
    two sets differ in as many shingles at least, and a pair that may not differ
    in so many is none, without exception.
    """
    bits = min(max(1 << (4 * len(values) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    places = (values & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(parity: bytes, size: int) -> np.ndarray:
    """The parity of fewer remainders, ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint64).reshape(-1, size // 8), axis=0)


def _may_be_similar(differing: np.ndarray, both: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of ``both`` shingles together, that differ in so many, may have that similarity."""
    percent = round(100 * similarity)
    return differing.astype(np.int64) * (100 + percent) <= both * (100 - percent)


def _least_agreement(similarity: float) -> float:
    bits, chance = TREES * DEPTH, (1 + similarity) / 2
    return bits * chance - SKETCH_DEVIATIONS * (bits * chance * (1 - chance)) ** 0.5


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """A row per document: n_shingles, set_id (a digest), shingles, keys, sketch and parity; null without words."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part, rows = batch.iloc[at : at + 1000], []
                for text in part["text"]:
                    values = shingles(text, size) if text else np.array([], np.uint64)
                    if len(values):
                        data = _packed(values)
                        rows.append((len(values), xxhash.xxh3_128_digest(data), data, *_keys(values), _parity(values)))
                    else:
                        rows.append((0, None, None, None, None, None))
                frame = pd.DataFrame(rows, columns=["n_shingles", "set_id", "shingles", "keys", "sketch", "parity"])
                frame.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
                yield frame.astype({"doc_id": "Int64"})
        forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(describe, SETS)


PAIRS = "a long, a_set long, b long, b_set long, near boolean"


def _neighbours(batches: Iterator[pd.DataFrame], similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs of rows that lie near each other in the order of their tree's keys.

    A row's region are the rows with its leading values: as many values as it
    takes for the region to have REGION members at most, MIN_DEPTH at least. It
    meets its whole region and, if there is no such depth, the NEXT ones.
    """
    rest, least = None, _least_agreement(similarity)
    for batch in batches:
        # Rows that may still have neighbours in the next batch go over to it.
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        carried = 0 if rest is None else len(rest)
        rest = frame.iloc[-REGION:].reset_index(drop=True)
        keys = np.frombuffer(b"".join(frame["tree_key"]), ">u2").reshape(len(frame), DEPTH + 1)
        n, nodes, sets = (frame[c].to_numpy() for c in ("n_shingles", "node", "node_set"))
        sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
        depth = np.full(len(frame), DEPTH + 2)
        for d in range(DEPTH, MIN_DEPTH - 1, -1):
            starts = np.r_[True, (keys[1:, : d + 1] != keys[:-1, : d + 1]).any(axis=1)]
            region = np.cumsum(starts) - 1
            depth[np.bincount(region)[region] <= REGION] = d
        found = []
        for offset in range(1, min(REGION, len(frame))):
            i = np.arange(max(offset, carried), len(frame))
            if not len(i):
                break
            j = i - offset
            asked = np.where(depth[i] <= DEPTH, depth[i], MIN_DEPTH if offset <= NEXT else DEPTH + 2)
            same = (keys[i] == keys[j]).cumprod(axis=1).sum(axis=1) - 1
            ok = (same >= asked) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
            if offset > NEXT and not (same >= MIN_DEPTH).any():
                break
            i, j = i[ok], j[ok]
            agreed = TREES * DEPTH - _ONES[sketches[i] ^ sketches[j]].sum(axis=1)
            i, j = i[agreed >= least], j[agreed >= least]
            near = (keys[i, 0] < FIRST_TREES) & (offset == 1)
            found.append((nodes[i], sets[i], nodes[j], sets[j], near))
        if found:
            a, a_set, b, b_set, near = (np.concatenate(x) for x in zip(*found))
            swap = (a > b) | ((a == b) & (a_set > b_set))
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            a_set, b_set = np.where(swap, b_set, a_set), np.where(swap, a_set, b_set)
            pairs = pd.DataFrame({"a": a, "a_set": a_set, "b": b, "b_set": b_set, "near": near})
            yield pairs.groupby(["a", "a_set", "b", "b_set"], as_index=False).agg({"near": "max"})


def candidates(classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs of classes that are neighbours in some tree of the forest, each once.

    ``classes``: node, node_set, n_shingles, keys and sketch. The rows of all trees are
    dealt by ranges of (tree, key, node), so a region of any size is spread. A
    pair that a range's border parts in one tree is left to the other trees.
    """
    # A tree's number, as two bytes, stands before its values.
    keys = [
        F.concat(
            F.lit(t.to_bytes(2, "big")),
            F.substring("keys", 2 * DEPTH * t + 1, 2 * DEPTH),
        )
        for t in range(TREES)
    ]
    rows = classes.select(F.explode(F.array(*keys)).alias("tree_key"), "node", "node_set", "n_shingles", "sketch")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree_key", "node", "node_set"]
    found = (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(lambda batches: _neighbours(batches, similarity), PAIRS)
    )
    return found.groupBy("a", "a_set", "b", "b_set").agg(F.max("near").alias("near"))


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _with_sets(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``pairs`` with n_shingles and that column of both sets."""
    ids = (
        pairs.select(F.col("a").alias("node"), F.col("a_set").alias("node_set"))
        .union(pairs.select("b", "b_set"))
        .distinct()
    )
    wanted = sets.join(_small(ids), ["node", "node_set"], "left_semi")

    def of(side: str) -> DataFrame:
        return wanted.select(
            F.col("node").alias(side),
            F.col("node_set").alias(f"{side}_set"),
            F.col("n_shingles").alias(f"{side}_n"),
            F.col(column).alias(f"{side}_{column}"),
        )

    # Dealt by id at every size: sets are wide, and how many are wanted is not known.
    return (
        pairs.select("a", "a_set", "b", "b_set")
        .join(of("a").hint("merge"), ["a", "a_set"])
        .join(of("b").hint("merge"), ["b", "b_set"])
    )


def possible(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs that the parities of their sets do not rule out, each once."""

    def fits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            differing = np.zeros(len(batch), np.int64)
            for k, (x, y) in enumerate(zip(batch["a_parity"], batch["b_parity"])):
                size = min(len(x), len(y))
                differing[k] = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(dtype=np.int64)
            ok = _may_be_similar(differing, (batch["a_n"] + batch["b_n"]).to_numpy(), similarity)
            yield batch.loc[ok, ["a", "a_set", "b", "b_set"]]

    found = _with_sets(pairs, sets, "parity").mapInPandas(fits, "a long, a_set long, b long, b_set long")
    return stored(found.distinct(), "possible")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (as links u, v) whose full shingle sets are similar enough.

    The sets, which are wide, are fetched for the pairs that their parities leave.
    """
    percent = round(100 * similarity)

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["a_shingles"], batch["b_shingles"]):
                both = np.concatenate((_unpacked(x), _unpacked(y)))
                union = len(np.unique(both))
                ok.append(100 * (len(both) - union) >= percent * union)
            yield batch.loc[ok, ["u", "v"]]

    return (
        _with_sets(possible(pairs, sets, similarity), sets, "shingles")
        .select(F.col("a").alias("u"), F.col("b").alias("v"), "a_shingles", "b_shingles")
        .mapInPandas(similar, "u long, v long")
    )


def _prefixes() -> Column:
    """A tree's number and its MIN_DEPTH leading values, a row per tree."""
    return F.explode(
        F.array(
            *[
                F.concat(F.lit(t.to_bytes(2, "big")), F.substring("keys", 2 * DEPTH * t + 1, 2 * MIN_DEPTH))
                for t in range(TREES)
            ]
        )
    ).alias("region")


def crowded(classes: DataFrame) -> DataFrame:
    """The classes of which more than REGION share a tree's MIN_DEPTH leading values, a row per such region."""
    regions = classes.select(_prefixes()).groupBy("region").count().filter(F.col("count") > REGION)
    regions = stored(regions.select("region"), "regions")
    rows = classes.select(_prefixes(), "node", "node_set", "n_shingles", "sketch")
    return stored(rows.join(_small(regions), "region", "left_semi"), "crowded")


def still_apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of regions that are not one component, with their component as ``root`` and the region's members."""
    rows = rows.drop("root", "members").join(_small(roots), F.col("node") == F.col("of"), "left")
    rows = rows.withColumn("root", F.coalesce("component", "node")).drop("of", "component")
    ends = rows.groupBy("region").agg(
        F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    apart = stored(ends.filter("low < high").select("region", "members"), "apart")
    return stored(rows.join(_small(apart), "region"), "crowded")


def rooted_by(links: DataFrame) -> DataFrame:
    """``of`` and component (the least node of its component) of all nodes with a link."""
    return stored(components(links).select(F.col("node").alias("of"), "component"), "roots")


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further ``links`` u, v: those between components decide, and only they are followed."""
    for side in "uv":
        found = roots.select(F.col("of").alias(side), F.col("component").alias(f"{side}_root"))
        links = links.join(_small(found), side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    between = links.select(F.col("u_root").alias("u"), F.col("v_root").alias("v")).filter("u <> v")
    more = rooted_by(between)
    now = more.select(F.col("of").alias("component"), F.col("component").alias("low"))
    kept = roots.join(_small(now), "component", "left").select("of", F.coalesce("low", "component").alias("component"))
    # A node without a link so far; a component's least node is in ``roots`` already.
    new = more.join(_small(roots.select("of")), "of", "left_anti")
    return stored(kept.union(new), "roots")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Each row once for every pair of blocks that its own block takes part in."""
    n = F.ceil(F.col("members") / size).cast("int")
    own = F.pmod(F.xxhash64("node", "node_set"), n).cast("int")
    return (
        rows.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
        .drop("other", "members")
    )


def _likely(frame: pd.DataFrame, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which pairs of a pair of blocks may be similar and lie in two components, and all agreements.

    A strip of rows with all others at a time, so that memory does not go with the square of a block.
    """
    bits = np.unpackbits(np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1), axis=1)
    signs = bits[:, : TREES * DEPTH].astype("f4") * 2 - 1
    n, root, block = (frame[c].to_numpy() for c in ("n_shingles", "root", "block"))
    two = frame["first"].iloc[0] != frame["second"].iloc[0]
    for at in range(0, len(frame), STRIP):
        own = slice(at, at + STRIP)
        agreed = (signs[own] @ signs.T + TREES * DEPTH) / 2
        ok = (agreed >= _least_agreement(similarity)) & (root[own, None] != root)
        ok &= np.minimum(n[own, None], n) >= similarity * np.maximum(n[own, None], n) - 1e-9
        if two:
            ok &= block[own, None] != block
        yield ok, agreed


HUBS = "a long, a_set long, b long, b_set long"


def hub_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """In each pair of blocks, the class that agrees most with all others, with each that may be similar."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        hub, most, near, at = 0, -1.0, None, 0
        for ok, agreed in _likely(frame, similarity):
            sums = (agreed * ok).sum(axis=1)
            best = int(sums.argmax())
            if sums[best] > most:
                hub, most, near = at + best, sums[best], ok[best]
            at += len(ok)
        with_hub = frame[near]
        pairs = pd.DataFrame({"a": with_hub["node"], "a_set": with_hub["node_set"]})
        return pairs.assign(b=frame["node"].iloc[hub], b_set=frame["node_set"].iloc[hub])

    return _blocks(rows, BLOCK).groupBy("region", "first", "second").applyInPandas(of, HUBS).distinct()


OPEN = "region binary, node long, node_set long"


def unsettled(rows: DataFrame, similarity: float) -> DataFrame:
    """region, node and node_set of the classes that may be similar to one of another component, by their sketches."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        found = np.concatenate([ok.any(axis=1) for ok, _ in _likely(frame, similarity)])
        return frame.loc[found, ["region", "node", "node_set"]]

    return _blocks(rows, BLOCK).groupBy("region", "first", "second").applyInPandas(of, OPEN).distinct()


def only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose region, node and node_set are ``wanted``."""
    wanted = stored(wanted, "unsettled")
    return stored(rows.join(_small(wanted), ["region", "node", "node_set"], "left_semi"), "crowded")


def _differing(parities: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many shingles rows i and j differ at least."""
    sizes = np.fromiter(map(len, parities), np.int64, len(parities))
    common, out = np.minimum(sizes[i], sizes[j]), np.zeros(len(i), np.int64)
    for size in np.unique(common).tolist():
        pairs, place = np.flatnonzero(common == size), np.cumsum(sizes >= size) - 1
        held = np.stack([_folded(parities[k], size) for k in np.flatnonzero(sizes >= size)])
        step = max(1, PAIRS_AT_ONCE * 256 // size)
        for at in range(0, len(pairs), step):
            part = pairs[at : at + step]
            out[part] = np.bitwise_count(held[place[i[part]]] ^ held[place[j[part]]]).sum(axis=1, dtype=np.int64)
    return out


def undecided(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of those classes, the ones that the parities of the sets do not rule out either."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        parities, n = frame["parity"].tolist(), frame["n_shingles"].to_numpy()
        found, at = np.zeros(len(frame), bool), 0
        for ok, _ in _likely(frame, similarity):
            i, j = np.nonzero(ok)
            i += at
            i, j = i[i < j], j[i < j]
            near = _may_be_similar(_differing(parities, i, j), n[i] + n[j], similarity)
            found[i[near]] = found[j[near]] = True
            at += len(ok)
        return frame.loc[found, ["region", "node", "node_set"]]

    with_parity = _with_set(rows, sets, "parity")
    return _blocks(with_parity, BLOCK).groupBy("region", "first", "second").applyInPandas(of, OPEN).distinct()


def _with_set(rows: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    ids = _small(rows.select("node", "node_set").distinct())
    once = sets.select("node", "node_set", column).join(ids, ["node", "node_set"], "left_semi")
    return rows.join(once.dropDuplicates(["node", "node_set"]).hint("merge"), ["node", "node_set"])


def _grouped(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the least row that links lead to."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label, len(label)).min(axis=1, initial=len(label)))
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share."""
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), "f4")
    for at in range(0, int((times > 1).sum()), COLUMNS):
        part = slice(*np.searchsorted(column, (at, at + COLUMNS)))
        held = np.zeros((len(sets), COLUMNS), "f4")
        held[row[part], column[part] - at] = 1
        out += held @ held.T
    return out


def settled(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links u, v that join what is similar in ``rows``, all pairs compared on full sets.

    A pair of blocks gives a link a class at most: to the least class that its
    similar ones lead to.
    """
    percent = round(100 * similarity)

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        ok = np.concatenate([strip for strip, _ in _likely(frame, similarity)])
        label, node, n = _grouped(ok), frame["node"].to_numpy(), frame["n_shingles"].to_numpy()
        u, v = [], []
        # Likely pairs lie within a label, so only its sets are compared.
        for group in np.unique(label[ok.any(axis=1)]):
            at = np.flatnonzero(label == group)
            both = _common([_unpacked(x) for x in frame["shingles"].iloc[at]])
            union = n[at][:, None] + n[at] - both
            lead = _grouped(ok[np.ix_(at, at)] & (100 * both >= percent * union))
            u.append(node[at])
            v.append(node[at[lead]])
        links = pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)} if u else {"u": [], "v": []}, dtype="int64")
        return links[links["u"] != links["v"]]

    return (
        _blocks(_with_set(rows, sets, "shingles"), SET_BLOCK)
        .groupBy("region", "first", "second")
        .applyInPandas(of, "u long, v long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    Documents are linked if the Jaccard similarity of their word-shingle sets is
    ``similarity`` or more. component_id is the least id that links lead to, and
    a document is kept if that is its own.

    Documents of one set are a class, told by a 128-bit digest and named by its
    least id; only classes enter the forest. Candidates that are nearest
    neighbours in the first trees are confirmed first; of the rest, those that
    are by then in one component are left out, as no further link can change
    that. So a large group of near copies costs a few pairs a member.

    Where more than REGION classes share MIN_DEPTH leading values of a tree and
    are not one component by then, all of them are compared: with hubs first,
    and then, in blocks, every pair that lies in two components and passes the
    tests of size and sketch. What the parities of the sets leave of these is
    compared on full sets.

    Null and empty texts, and texts without words, have no shingles and no link.
    A row without an id is linked with nothing, and kept. Rows that share an id
    are one document. Only doc_id and text are read, so other columns cannot
    clash; an empty table gives an empty result.
    """
    described = stored(shingle_sets(docs, size), "shingles")
    found = described.filter(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    classes = stored(
        found.groupBy("set_id", "n_shingles", "keys", "sketch")
        .agg(F.min("doc_id").alias("node"))
        .withColumn("node_set", F.xxhash64("set_id")),
        "classes",
    )
    sets = found.select(
        F.col("doc_id").alias("node"), F.xxhash64("set_id").alias("node_set"), "n_shingles", "shingles", "parity"
    )
    pairs = stored(candidates(classes, similarity), "candidates")
    # A row per class: repeated rows of a document would repeat its pairs.
    roots = rooted_by(confirmed(pairs.filter("near"), sets, similarity).distinct())
    rest = pairs.filter(~F.col("near"))
    for side in "ab":
        found_roots = roots.select(F.col("of").alias(side), F.col("component").alias(f"{side}_root"))
        rest = rest.join(_small(found_roots), side, "left")
    apart = F.coalesce("a_root", "a") != F.coalesce("b_root", "b")
    rest = stored(rest.filter(apart).select("a", "a_set", "b", "b_set"), "rest")
    roots = joined_roots(roots, confirmed(rest, sets, similarity).distinct())
    rows = still_apart(crowded(classes), roots)
    if not rows.isEmpty():
        hubs = stored(hub_pairs(rows, similarity), "hubs")
        roots = joined_roots(roots, confirmed(hubs, sets, similarity).distinct())
        rows = still_apart(rows, roots)
        rows = only(rows, unsettled(rows, similarity))
        rows = still_apart(only(rows, undecided(rows, sets, similarity)), roots)
        if not rows.isEmpty():
            roots = joined_roots(roots, settled(rows, sets, similarity))
    named = classes.select("set_id", "node").join(_small(roots), F.col("node") == F.col("of"), "left").select(
        "set_id", F.coalesce("component", "node").alias("component_id")
    )
    return (
        described.select("doc_id", "n_shingles", "set_id")
        .join(named, "set_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def deduplicated(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each component, with its own columns; rows without an id stay."""
    found = near_duplicates(docs, size, similarity)
    kept = found.filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("d_id")).distinct()
    renamed, back = set_aside(docs, d_id=F.col("doc_id"), d_order=F.xxhash64("text"))
    first = Window.partitionBy("d_id").orderBy("d_order")
    return (
        renamed.filter(F.col("d_id").isNotNull())
        .join(kept, "d_id", "left_semi")
        .withColumn("d_row", F.row_number().over(first))
        .filter("d_row = 1")
        .select(*back)
        .unionByName(renamed.filter(F.col("d_id").isNull()).select(*back))
    )
