"""Phrases, packing and conversations on hand-made and random small inputs."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import conversations, packing, phrases, tokens_file

CLASH = ["row", "n", "hash", "words", "phrase", "a", "path", "base", "tokens", "ids", "group", "shard", "kind", "turns"]
BYTE_MODEL = tokens_file.model_text(public_tokenizers.path("byte_bpe_50k.json"))


def with_clash(df):
    return df.withColumns({c: F.lit(f"mine-{c}") for c in CLASH})


# Phrases


def plain_collocations(rows, threshold, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        big = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        found = []
        for p, a in big.items():
            inside = [b for q, b in big.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def found_collocations(df, **options):
    return sorted(map(tuple, phrases.collocations(df, **options).collect()))


def phrase_rows(seed, n=60):
    r = np.random.default_rng(seed)
    words = ["a", "B", "b", "über", "c d", "e", "f\x1fg", "日本", "h", "i"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "!", "; ", "\x0b", "\x85"]
    langs = ["en", None, "und", "de"]
    texts = ["".join(words[min(9, int(r.exponential(2)))] + ends[r.integers(0, 12)] for _ in range(r.integers(0, 60))) for _ in range(n)]
    return [(langs[r.integers(0, 4)], t) for t in texts] + [("en", None), ("en", ""), (None, " \t\n")]


@pytest.mark.parametrize("seed", range(4))
def test_collocations_equal_a_plain_count(spark, monkeypatch, seed):
    # Small blocks, slices, partitions and maps, so that all of them are crossed, and bits shared.
    monkeypatch.setattr(phrases, "GATHERED", 50)
    monkeypatch.setattr(phrases, "SLICE", 7)
    monkeypatch.setattr(phrases, "HELD_ROWS", 20)
    monkeypatch.setattr(phrases, "PARTITION_MASS", 64)
    monkeypatch.setattr(phrases, "TAKEN_IN", 16)
    monkeypatch.setattr(phrases, "MAP_BITS", 1 << 15)
    rows = phrase_rows(seed)
    df = with_clash(spark.createDataFrame(rows, "lang string, text string"))
    assert found_collocations(df, threshold=5, top=7) == plain_collocations(rows, 5, 7)


def test_collocations_edges(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert found_collocations(empty) == []
    rows = [("en", "x " * 200_000)] + [("en", "New York")] * 40 + [(None, "só um")] * 30
    assert found_collocations(spark.createDataFrame(rows, "lang string, text string")) == plain_collocations(rows, 30, 2000)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=8), st.integers(1, 6))
def test_summaries_lose_no_frequent_hash(parts, threshold):
    mass = sum(map(len, parts))
    summary = phrases.Summary(mass // threshold + 1)
    for part in parts:
        summary.merge(np.array(part, np.uint64), np.ones(len(part), "i8"))
        assert len(summary.hashes) <= summary.capacity
    counts = Counter(x for part in parts for x in part)
    assert {x for x, n in counts.items() if n >= threshold} <= set(summary.possible(threshold).tolist())
    assert summary.off < threshold


def test_bit_map_holds_all_hashes(spark):
    own = np.random.default_rng(3).integers(0, 2**64, 500, np.uint64)
    df = spark.createDataFrame([(int(x),) for x in own.view("i8")], "hash long")
    found = phrases.bit_map(df, 500).value
    assert found(own).all()
    other = np.random.default_rng(4).integers(0, 2**64, 10_000, np.uint64)
    assert found(other).mean() < 0.1


# Packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 1023), min_size=1, max_size=60), st.integers(1, 12))
def test_differencing_is_a_partition(sizes, k):
    windows, sums = packing.differenced(np.array(sizes), k)
    assert [sum(s for s, w in zip(sizes, windows) if w == i) for i in range(k)] == sums.tolist()
    assert (np.diff(sums) <= 0).all()


@pytest.mark.parametrize("sizes", [[700] * 500, [520] * 500, [345] * 900, [1] * 3000, [1023] * 300, list(range(1, 900))])
def test_windows_are_near_equal_and_full(sizes):
    pieces, windows, k = packing.packed(sizes)
    assert [sum(p) for p in pieces] == sizes and all(min(p) > 0 for p in pieces)
    filled = Counter()
    for own, where in zip(pieces, windows):
        for p, w in zip(own, where):
            filled[w] += p
    assert max(filled.values()) <= 1024 and set(filled) <= set(range(k))
    assert k <= -(-sum(sizes) // 1024) + max(1, len(filled) // 128)


def test_nothing_to_pack():
    assert packing.packed([]) == ([], [], 0)


def packing_rows():
    r = np.random.default_rng(5)
    texts = [None, "", "one", "<|endoftext|>", "tail <|endoftext|>  x", "y" * 20_000, "long text " * 30_000]
    texts += ["".join(map(chr, r.integers(32, 0x500, r.integers(0, 400)))) for _ in range(150)]
    return list(enumerate(texts)) + [(7, "again"), (7, "again"), (None, "no id"), (None, None)]


def test_sequences_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    df = with_clash(spark.createDataFrame(packing_rows(), "doc_id long, text string"))
    pieces = packing.pack(df, BYTE_MODEL)
    got = pieces.collect()
    library = Tokenizer.from_str(BYTE_MODEL)
    wanted = Counter((d, tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for d, t in packing_rows())
    alone = Counter(d for d, _ in packing_rows())
    for doc_id, ids in wanted:
        if alone[doc_id] == 1:
            own = sorted((r.start, r.length, r.ids) for r in got if r.doc_id == doc_id)
            assert b"".join(i for _, _, i in own) == np.array(ids, "<u4").tobytes()
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in wanted.items())
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, bytes(r.ids)))
    assert filled.keys() == whole.keys()
    for name, own in filled.items():
        joined = b"".join(i for _, i in sorted(own))
        assert bytes(whole[name].ids).startswith(joined) and whole[name].n_tokens == len(joined) // 4
        n = whole[name].n_tokens
        assert len(whole[name].ids) == 4 * (n if n & (n - 1) == 0 else 1024)


def test_no_documents_to_pack(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), BYTE_MODEL).collect() == []


def test_another_tokenizer_file_is_left_to_its_library(spark):
    from tokenizers import Tokenizer

    model = tokens_file.model_text(public_tokenizers.path("word_bpe_49k.json"))
    assert packing.Encoder(model).fast is None
    text = "Another kind of file: déjà vu!"
    assert packing.Encoder(model)(text).tolist() == Tokenizer.from_str(model).encode(text, add_special_tokens=False).ids
    changed = json.loads(BYTE_MODEL)
    changed["pre_tokenizer"]["add_prefix_space"] = True
    assert packing.Encoder(json.dumps(changed)).fast is None
    assert packing.Encoder(BYTE_MODEL).fast is not None


# Conversations


def plain_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - c % 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = []
    for node, own in members.items():
        below = [q for q in members if q[: len(node)] == node]
        children = [q for q in below if len(q) == len(node) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:-1] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len([w for w in re.split(r"[\x20\x09-\x0D]+", q[-1][1]) if w]) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in own if paths[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_trie(spark, rows):
    df = with_clash(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    return sorted(map(tuple, conversations.prefix_trie(df).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_a_plain_one(spark, monkeypatch, seed):
    monkeypatch.setattr(conversations, "SHARD_ROWS", 9)
    monkeypatch.setattr(conversations, "JOINED_IDS", 3)
    r = np.random.default_rng(seed)
    texts = ["a", "a b", "", None, "c  d\te", "ü"]
    rows = []
    for c in r.choice(400, 150, replace=False).tolist():
        for turn in range(int(r.integers(1, 6))):
            rows.append((c, turn if turn or r.random() < 0.7 else None, ["u", "v", None][r.integers(0, 3)] if r.random() < 0.2 else "u", texts[min(5, int(r.exponential(0.7)))]))
    rows += [(None, 0, "u", "x"), (77_777, 3, None, None)]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_a_third_of_all_conversations_alike_and_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SHARD_ROWS", 20)
    monkeypatch.setattr(conversations, "JOINED_IDS", 7)
    rows = [(c, t, "u", f"same {t}") for c in range(0, 2000, 20) for t in range(3)]
    rows += [(c * 20 + 5, t, "u", f"own {c % 50} {t // 2}") for c in range(60) for t in range(4)]
    rows += [(40_000, t, "u", f"turn {t}") for t in range(300)]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_no_conversations(spark):
    assert found_trie(spark, []) == []
    # Only a later conversation of a group, all of whose turns go: the root is left.
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    assert found_trie(spark, [(c, 0, "u", "x")]) == plain_trie([(c, 0, "u", "x")])
