"""Prefix trie of conversations, built in sorted shards around a skeleton.

Every conversation is a path: a digest per turn, joined. Paths are dealt into
shards by splitters, (path, conversation) pairs of a sample, so that
equal paths spread as well. A node that has conversations in two shards is a
prefix of the splitter between them, so the trie of the splitters' paths, the
skeleton, has all nodes that no shard knows alone. It is broadcast. Each shard
sweeps its sorted paths and finishes the other nodes; of the skeleton's nodes it
gives partial sums, which are then combined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.mixing import word_size
from ledgerlens.llm.text import stored, total

# Turns that a conversation may take from its group's first one; conversations of a group.
SHARED_TURNS, GROUP = 4, 20
# Characters of a turn's digest.
DIGEST = 32
# Conversations of a shard; sampled ones behind each splitter.
SHARD_ROWS, SAMPLED = 200_000, 20
# Ids that are joined to one text on their way to a hash.
JOINED_IDS = 50_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SWEPT = f"kind string, node long, parent long, tokens long, shard long, place long, joined string, {NODE}"
_COLUMNS = [field.split()[0] for field in _SWEPT.split(", ")]


def _digest(role: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path and tokens (words of each turn) of every rebuilt conversation.

    A conversation's first h turns are those of its group's first one. Turns are
    in order of turn, null first, then of their digest. The texts stay where
    they are: a digest and a count of each turn are shuffled, once, by group.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    small = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", base.alias("base"), F.struct("turn", _digest(role, text).alias("digest"), word_size(text).alias("tokens")).alias("t")
    )
    own = small.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    first = own.filter(F.col("conv_id") == F.col("base")).select("base", F.slice("turns", 1, SHARED_TURNS - 1).alias("shared"))
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).cast("int")
    shared = F.coalesce(F.slice("shared", F.lit(1), h), F.slice("turns", 1, 0))
    return (
        own.join(first, "base", "left")
        .withColumn("turns", F.concat(shared, F.slice("turns", h + 1, F.size("turns"))))
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("path"),
            F.transform("turns", lambda t: t["tokens"]).alias("tokens"),
        )
    )


class Skeleton:
    """The trie of the splitters' paths. Nodes are numbered, the root 0, each after its parent.

    ``nodes``: the number of a node, by its parent's and its turn's digest.
    """

    def __init__(self, splitters: list[tuple[str, int]]) -> None:
        self.splitters = splitters
        self.nodes: dict[tuple[int, str], int] = {}
        self.parents: list[int | None] = [None]
        for path, _ in splitters:
            parent = 0
            for at in range(0, len(path), DIGEST):
                node = self.nodes.setdefault((parent, path[at : at + DIGEST]), len(self.parents))
                if node == len(self.parents):
                    self.parents.append(parent)
                parent = node

    def summed(self, values: dict[int, tuple[int, ...]]) -> dict[int, tuple[int, ...]]:
        """Values of each node, with those of all nodes below it."""
        out = dict(values)
        for node in range(len(self.parents) - 1, 0, -1):
            above = self.parents[node]
            out[above] = tuple(a + b for a, b in zip(out[above], out[node]))
        return out


def skeleton(paths: DataFrame, shards: int) -> Skeleton:
    """``shards`` - 1 splitters from a sample of SAMPLED conversations a shard; only they come to the driver."""
    spark = paths.sparkSession
    n = paths.count()
    wanted = SAMPLED * shards
    sample = paths.select("path", "conv_id")
    if n > wanted:
        share = wanted / n
        sample = sample.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most a few more than ``wanted`` rows in this window.
    place = F.row_number().over(Window.orderBy("path", "conv_id"))
    every = max(1, -(-min(n, wanted) // shards))
    rows = sample.withColumn("place", place).filter(F.col("place") % every == 0).orderBy("place").collect()
    return Skeleton([(r["path"], r["conv_id"]) for r in rows])


class _Node:
    __slots__ = ("node", "first", "n", "children", "leaves", "saved", "tokens", "ends", "done")

    def __init__(self, node: int | None, tokens: int) -> None:
        self.node, self.tokens = node, tokens
        self.first, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[str] | None = None
        # Finished children that wait for this node's least conversation.
        self.done: list[list] = []


class _Sweep:
    """One shard's sorted paths, one after the other; ``rows`` are what it has finished."""

    def __init__(self, shard: int, known: Skeleton) -> None:
        self.shard, self.nodes, self.parents = shard, known.nodes, known.parents
        self.rows: list[list] = []
        self.digests: list[str] = []
        self.stack = [_Node(0, 0)]
        self.places = 0

    def _send(self, node: _Node) -> None:
        self.rows.append(["ends", node.node, None, None, self.shard, self.places, ",".join(node.ends), *[None] * 8])
        self.places += 1
        node.ends = None

    def close(self, depth: int) -> None:
        """Finish all nodes deeper than ``depth``."""
        while len(self.stack) - 1 > depth:
            self._finish(self.stack.pop(), self.stack[-1] if self.stack else None, len(self.stack))

    def finish(self) -> None:
        self.close(0)
        self._finish(self.stack.pop(), None, 0)

    def _finish(self, node: _Node, parent: _Node | None, depth: int) -> None:
        if node.node is not None:
            # What the shard knows of a node of the skeleton; subtrees of its own children included.
            if node.ends:
                self._send(node)
            parent_node = self.parents[node.node]
            self.rows.append(
                ["part", node.node, parent_node, node.tokens, self.shard, None, None]
                + [node.first, depth, None, node.n, node.children, node.leaves, node.saved, None]
            )
        else:
            node.saved += (node.n - 1) * node.tokens
            node.leaves = node.leaves or 1
            ends = hashlib.sha256(",".join(node.ends or []).encode()).hexdigest()
            row = ["node", None, parent.node, None, None, None, None]
            row += [node.first, depth, None, node.n, node.children, node.leaves, node.saved, ends]
            # A parent in the skeleton is told by its number, and its least conversation is joined later.
            (parent.done if parent.node is None else self.rows).append(row)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
        if parent is not None:
            parent.n += node.n
            parent.first = node.first if parent.first is None else min(parent.first, node.first)
        for row in node.done:
            row[_COLUMNS.index("parent_conv_id")] = node.first
        self.rows += node.done

    def add(self, path: str, conv_id: int, tokens: list[int]) -> None:
        digests = [path[at : at + DIGEST] for at in range(0, len(path), DIGEST)]
        here = 0
        for mine, before in zip(digests, self.digests):
            if mine != before:
                break
            here += 1
        self.close(here)
        for digest, n in zip(digests[here:], tokens[here:]):
            # Below a node that is not in the skeleton there is none that is.
            self.stack.append(_Node(self.nodes.get((self.stack[-1].node, digest)), int(n)))
        self.digests = digests
        last = self.stack[-1]
        last.n += 1
        last.first = conv_id if last.first is None else min(last.first, conv_id)
        last.ends = last.ends or []
        last.ends.append(str(conv_id))
        if last.node is not None and len(last.ends) >= JOINED_IDS:
            self._send(last)


def _swept(paths: DataFrame, shared: Broadcast) -> DataFrame:
    """Finished nodes, and parts and ends of the skeleton's, of all shards."""
    shards = len(shared.value.splitters) + 1

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        import bisect

        splitters = shared.value.splitters
        return pd.Series([bisect.bisect_right(splitters, key) for key in zip(path, conv_id)], dtype="int32")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = shared.value
        state = None
        for batch in batches:
            for shard, path, conv_id, tokens in zip(*(batch[c].tolist() for c in ("shard", "path", "conv_id", "tokens"))):
                if state is None or state.shard != shard:
                    if state is not None:
                        state.finish()
                        yield _frame(state.rows)
                    state = _Sweep(shard, found)
                state.add(path, conv_id, tokens)
            if state is not None and state.rows:
                yield _frame(state.rows)
                state.rows = []
        if state is not None:
            state.finish()
            yield _frame(state.rows)

    dealt = paths.withColumn("shard", shard_of("path", "conv_id"))
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id").mapInPandas(sweep, _SWEPT)


def _frame(rows: list[list]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype(
        {c: "Int64" for c in _COLUMNS if c not in ("kind", "joined", "ends_sha256")}
    )


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """node and ends_sha256 of the skeleton's nodes at which conversations end.

    The hash of a list is made from its front to its back, so one task reads a
    node's ids, joined to texts of JOINED_IDS already; it holds one of those.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest = None, None
        for batch in batches:
            out = []
            for own, joined in zip(batch["node"].tolist(), batch["joined"].tolist()):
                if own == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                digest.update(joined.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, digest.hexdigest())], columns=["node", "ends_sha256"])

    return (
        ends.select("node", "shard", "place", "joined")
        .repartition("node")
        .sortWithinPartitions("node", "shard", "place")
        .mapInPandas(read, "node long, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of `rebuilt` conversations.

    conv_id: the node's least conversation; depth; parent_conv_id: its parent's,
    null for the root; n_convs; n_children; n_leaves of its subtree;
    saved_tokens: over its subtree, (n_convs - 1) times the words of the last
    turn; ends_sha256: of the conversations that end there, in order, joined by
    commas. ``turns`` has conv_id, turn, role and text; a null role or text is
    empty, rows without conv_id are left out, and repeated rows are turns each.
    Very long texts are only digested; a very long conversation is held by one
    task, as some 70 bytes a turn. Other columns are not read, so none can
    clash. An empty table gives an empty result: there is no root without
    conversations.
    """
    spark = turns.sparkSession
    paths = stored(rebuilt(turns), "paths")
    n = paths.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_ROWS))
    found = skeleton(paths, shards)
    swept = stored(_swept(paths, spark.sparkContext.broadcast(found)), "swept")

    parts = swept.filter(F.col("kind") == "part").groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.max("tokens").alias("tokens"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    below = parts.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("inner"))
    own = (
        parts.join(below, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0)))
        .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("tokens"))
    )
    own = stored(own, "skeleton")
    # Two numbers per node of the skeleton, which the driver made and holds.
    values = {r["node"]: (r["n_leaves"], r["saved_tokens"]) for r in own.select("node", "n_leaves", "saved_tokens").collect()}
    whole = [(node, *sums) for node, sums in found.summed(values).items()] if values else []
    sums = spark.createDataFrame(whole, "node long, n_leaves long, saved_tokens long")
    ends = _hashed_ends(swept.filter(F.col("kind") == "ends"))
    above = own.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256().hexdigest()
    inner = (
        own.drop("n_leaves", "saved_tokens")
        .join(sums, "node")
        .join(above, "parent", "left")
        .join(ends, "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    )
    names = [field.split()[0] for field in NODE.split(", ")]
    rest = swept.filter(F.col("kind") == "node").join(above.toDF("parent", "above"), "parent", "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*names).unionByName(rest.select(*names))
