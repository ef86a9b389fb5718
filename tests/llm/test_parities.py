"""Near-duplicates: parities, memory of a pair of blocks, and components that grow."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from test_parts import star

from ledgerlens.llm import neardup


def parity_of(pair):
    return [neardup._parity(np.array(sorted(s), np.uint64)) for s in pair]


@pytest.mark.parametrize("size", [5, 45, 180, 1500, 40_000])
def test_parities_rule_out_no_similar_pair(size):
    r = np.random.default_rng(size)
    for apart in (0, 1, 10, 20, 40):
        # 100 * intersection is (100 - apart) percent of the union, or just below 80 for the last.
        values = r.integers(0, 1 << 48, size, dtype=np.uint64)
        gone = size * apart // 100
        sets = values[: size - gone // 2], values[gone - gone // 2 :]
        common = len(np.intersect1d(*sets))
        similar = 100 * common >= 80 * len(np.union1d(*sets))
        assert similar or apart > 20
        parities = parity_of(sets)
        differing = neardup._differing(parities, np.array([0]), np.array([1]))
        assert differing[0] <= len(np.setxor1d(*sets))
        likely = neardup._may_be_similar(differing, np.array([sum(map(len, sets))]), 0.8)[0]
        assert likely if similar else not likely or size < 20


def test_parities_of_unlike_sizes_are_compared():
    small, large = np.arange(60, dtype=np.uint64), np.arange(75, dtype=np.uint64)
    x, y = neardup._parity(small), neardup._parity(large)
    assert len(x) < len(y)
    assert neardup._differing([x, y, x], np.array([0, 0]), np.array([1, 2])).tolist() == [15, 0]


def test_a_pair_of_blocks_takes_little_memory():
    n, r = 2 * neardup.BLOCK, np.random.default_rng(1)
    frame = pd.DataFrame(
        {
            "sketch": [r.bytes(neardup.TREES * neardup.DEPTH // 8) for _ in range(n)],
            "n_shingles": r.integers(100, 130, n),
            "root": np.arange(n),
            "block": np.arange(n) % 2,
            "first": 0,
            "second": 1,
        }
    )
    tracemalloc.start()
    for _ in neardup._likely(frame, 0.8):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_crowded_regions_are_looked_for_once(spark, monkeypatch):
    rows, calls, plain = star(1000, 20), [], neardup.crowded

    def counted(*given):
        calls.append(given)
        return plain(*given)

    monkeypatch.setattr(neardup, "crowded", counted)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.component_id for r in got} == {0} and len(got) == len(rows)
    assert len(calls) == 1


def test_components_grow_by_links_between_them(spark):
    def links(*pairs):
        return spark.createDataFrame(list(pairs), "u long, v long")

    roots = neardup.rooted_by(links((5, 6), (7, 8), (9, 10)))
    roots = neardup.joined_roots(roots, links((6, 8), (10, 3), (2, 1), (5, 6), (4, 4)))
    assert {r.of: r.component for r in roots.collect()} == {5: 5, 6: 5, 7: 5, 8: 5, 9: 3, 10: 3, 3: 3, 1: 1, 2: 1}
    roots = neardup.joined_roots(neardup.joined_roots(roots, links((8, 2))), links().limit(0))
    assert {r.of: r.component for r in roots.collect()} == {5: 1, 6: 1, 7: 1, 8: 1, 9: 3, 10: 3, 3: 3, 1: 1, 2: 1}
