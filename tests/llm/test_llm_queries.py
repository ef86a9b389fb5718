"""The registered queries against SQL, the public libraries, or plain versions."""

import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import brute
import numpy as np
import public_tokenizers
import pytest
from compare import TESTDATA, connect, duck_rows, spark_rows

from __spark_entry__ import oracle_sql, queries
from ledgerlens.llm import licenses, ngram_lm
from ledgerlens.llm.oracle import ORACLE
from ledgerlens.llm.queries import QUERIES

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    con = connect(TESTDATA / SF)
    yield con
    con.close()


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return queries()[name](spark, str(TESTDATA / SF)).collect()


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= queries().keys()
    assert ORACLE.keys() <= oracle_sql().keys()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    types, got = spark_rows(queries()[name](spark, str(TESTDATA / SF)))
    wanted_types, wanted = duck_rows(con, ORACLE[name])
    assert types == wanted_types
    assert got == wanted


def test_native_rules_run_no_python(spark):
    df = QUERIES["op9_quality_divergence"](spark, str(TESTDATA / SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_near_duplicates_equal_all_pairs(spark, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op2_minhash_forest")}
    assert got == brute.near_duplicates(documents, 2)


def test_pages_equal_a_plain_reading(spark, con):
    got = {r.page_id: (r.text, r.n_chars) for r in rows(spark, "op3_host_consensus")}
    pages = con.sql("SELECT page_id, html FROM pages").fetchall()
    assert len(got) == len(pages)
    for page_id, html in pages:
        article = html[html.index("<article>") + 9 : html.index("</article>")].replace("<br>", " ")
        parts = [unescape(re.sub("</?b>", "", p)) for p in re.split("</?(?:p|h1)>", article)]
        wanted = "\n".join(" ".join(p.split()) for p in parts if p.strip())
        assert got[page_id] == (wanted, len(wanted))


def test_pieces_equal_the_library(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in rows(spark, "op4_piece_lattice")}
    for doc_id, text in documents:
        ids = library.encode(text or "")
        assert list(got[doc_id].ids) == ids and got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert got[doc_id].decoded_crc32 == zlib.crc32((text or "").encode())


def test_no_long_passage_stands_twice(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op5_line_chunks")}
    repeated = brute.repeated_passages(t for _, t in documents)
    assert repeated and not brute.repeated_passages(r.text for r in got.values())
    for doc_id, text in documents:
        assert got[doc_id].n_removed_lines or got[doc_id].text == text
        # The first document with a passage keeps it.
        if not brute.passages(text) & repeated:
            continue
        first = [p for p in brute.passages(text) if not any(p in (t or "") for d, t in documents if d < doc_id)]
        assert all(p in got[doc_id].text for p in first if p.count("\n") == 0)


def test_records_equal_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op6_token_records")}
    start = 0
    for doc_id, text in documents:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_license_places_equal_a_plain_search(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op7_license_diagonals")}
    for doc_id, text in documents:
        n, places = brute.phrase_places(text, licenses.PHRASES)
        row, starts = got[doc_id], [i for i, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        assert (row.n_words, row.n_base, row.base_labels) == (n, len(places), labels)
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert set(labels.split(",")) <= set(row.labels.split(",")) or not labels
        assert 0 <= row.score <= 1


def test_scores_equal_a_plain_model(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op8_ngram_trie")}
    held_out = {d for d, _ in documents if zlib.crc32(str(d).encode()) % 10 == 0}
    score, total = brute.language_model([t for d, t in documents if d not in held_out], ngram_lm.MU)
    gain = 0.0
    for doc_id, text in documents:
        row = got[doc_id]
        tokens, known, base, model = score(text)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (doc_id in held_out, tokens, known, total)
        assert row.base_score == pytest.approx(base)
        assert abs(row.score - model) <= tokens / ngram_lm.STEPS
        gain += (row.score - row.base_score) * row.held_out
    assert gain > 0


def test_mix_comes_near_its_targets(spark):
    got = queries()["op10_mix_systematic"](spark, str(TESTDATA / "sf0.01")).collect()
    con = connect(TESTDATA / "sf0.01")
    sources = dict(con.sql("SELECT doc_id, source FROM documents").fetchall())
    con.close()
    sizes, taken, target = Counter(), Counter(), {}
    longest = defaultdict(int)
    for r in got:
        s = sources[r.doc_id]
        sizes[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        longest[s] = max(longest[s], r["size"])
        assert 0 <= r.taken <= 2 * r["size"]
    for s, wanted in brute.water_level(sizes).items():
        assert target[s] == pytest.approx(wanted)
        assert abs(taken[s] - wanted) <= longest[s]
    assert queries()["op10_mix_systematic"](spark, str(TESTDATA / "sf0.01")).exceptAll(
        spark.createDataFrame(got, queries()["op10_mix_systematic"](spark, str(TESTDATA / "sf0.01")).schema)
    ).isEmpty()


def test_pieces_of_sequences_equal_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op12_differencing_windows"):
        pieces[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in documents:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.length > 0 and (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    sizes = []
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        sizes.append(sum(n for _, n in own))
    assert max(sizes) <= 1024
    assert sum(1024 - n for n in sizes if n & (n - 1)) < 0.01 * sum(sizes)
