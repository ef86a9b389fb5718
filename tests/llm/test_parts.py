"""The operators on hand-made and random small inputs."""


import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.llm import components, html, licenses, lines, mapped, mixing, neardup, ngram_lm, quality, sentencepiece, tokens_file, topk
from ledgerlens.llm.eliasfano import EliasFano
from ledgerlens.session import scratch_path

WORDS = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
PASSAGE = " ".join(f"{WORDS[i % 17]}{i}" for i in range(60))
DOCS = "doc_id long, text string, source string, lang string, n_chars long"
# Columns that operators make by these names themselves.
CLASH = ["size", "taken", "copies", "target", "source_size", "q_kept", "q_text", "cut_text", "n_removed_lines", "own_0", "d_id", "d_row", "m_rank", "ids", "kept"]
MODEL = public_tokenizers.path("word_bpe_49k.json")


def prose(seed):
    """400 words, half of them frequent ones, that no rule rejects."""
    r = np.random.default_rng(seed)
    rare = [f"{WORDS[i]}{WORDS[j]}".lower() for i, j in r.integers(0, 17, (200, 2))]
    return " ".join(r.permutation(rare + list(r.choice(quality.COMMON["en"].split(), 200))))


def edge_rows():
    long_text = "\n".join(" ".join(f"{w}{i}" for w in WORDS) for i in range(3000))
    texts = [None, "", "   \n\t ", "one", "one two", PASSAGE, PASSAGE, f"a\n{PASSAGE}\nb", long_text, "x" * 5000, "a\n" * 50]
    texts += [prose(i) for i in range(3)]
    rows = [(i, t, f"s{i % 3}", "en", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, PASSAGE, None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame(edge_rows(), DOCS)
    return df.withColumns({c: F.lit(f"mine-{c}") for c in CLASH} | {"map of x": F.create_map(F.lit("k"), F.lit(1))})


@pytest.fixture(scope="module")
def model():
    return sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model"))


REPORTS = {
    "quality": quality.report,
    "mixing": mixing.report,
    "tokens": lambda df: tokens_file.report(df, tokens_file.model_text(MODEL)),
    "licenses": licenses.report,
    "neardup": neardup.near_duplicates,
    "lines": lines.report,
    "lm": ngram_lm.report,
    "pieces": lambda df: sentencepiece.report(df, sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model"))),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_edge_rows_and_no_rows(spark, edges, name):
    got = REPORTS[name](edges).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(
        (r[0] is None, r[0] or 0) for r in edge_rows()
    )
    assert REPORTS[name](edges.filter("false")).collect() == []


STAGES = {
    "quality": quality.accepted,
    "lines": lines.without_repeats,
    "neardup": neardup.deduplicated,
    "mixing": mixing.mixed,
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stages_keep_all_columns(edges, name):
    got = STAGES[name](edges)
    assert got.columns == edges.columns
    out = got.collect()
    assert out and all(r[c] == f"mine-{c}" for r in out for c in CLASH)
    assert all(r["map of x"] == {"k": 1} for r in out)
    assert STAGES[name](edges.filter("false")).collect() == []


# Top-k


def search(spark, vectors, every=2, k=3):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.report(df, every, k).collect()))


def brute_search(vectors, every=2, k=3):
    good = [(i, np.floor(np.array(v, "f4").astype("f8") * 256)) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        best = sorted((-int(sum(a * b for a, b in zip(v, w))), i) for i, w in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_edge_vectors(spark):
    vectors = [
        (0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None), (4, [None, 1.0]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [-1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]),
    ]
    assert search(spark, vectors) == brute_search(vectors)
    assert search(spark, []) == []


def test_top_k_of_very_large_components(spark):
    vectors = [(0, [1e7, 3.0]), (1, [2e3, 1e7]), (2, [1.0, -1e7]), (3, [1e30, 1.0])]
    got = search(spark, vectors[:3])
    assert got == brute_search(vectors[:3])
    assert max(r[3] for r in search(spark, vectors)) == 2**63 - 1


@settings(max_examples=15, deadline=None)
@given(seed=st.integers(0, 10**6), spread=st.sampled_from([0.01, 0.3, 3.0]))
def test_top_k_prunes_nothing_wanted(seed, spread):
    import pyarrow as pa

    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, 32))
    vectors = (centres[r.integers(0, 5, 300)] + spread * r.normal(size=(300, 32))).astype("f4")
    table = pa.table({"vec_id": list(range(300)), "embedding": list(vectors), "query_part": [0] * 300})
    found = topk._search(table.take(list(range(0, 300, 10))), table, 5)
    whole = np.floor(vectors.astype("f8") * 256)
    for q in range(0, 300, 10):
        order = sorted((-int(s), i) for i, s in enumerate(whole @ whole[q]) if i != q)[:5]
        mine = found["query_id"] == q
        assert list(zip(-found["score"][mine], found["vec_id"][mine])) == order


def test_queries_are_dealt_by_their_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_QUERIES", 4)
    vectors = [(i, [float(x) for x in np.random.default_rng(i).normal(size=8).astype("f4")]) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = topk.report(df, 2, 3)
    assert sorted(map(tuple, found.collect())) == brute_search(vectors, 2, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.split("\n") if "query_tile" in line and "pmod" in line]
    assert dealt and not any("monotonically" in line or "SPARK_PARTITION" in line for line in dealt if "AS query_tile" in line.split("pmod")[1])


# Near-duplicates


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_edited_copies(spark, size):
    r = np.random.default_rng(7)
    rows = []
    for family in range(12):
        text = [f"{WORDS[i]}{family if family % 3 else ''}" for i in r.integers(0, 17, 120)]
        for copy in range(8):
            own = list(text)
            for _ in range(copy):
                own[r.integers(0, 120)] = f"new{r.integers(0, 99)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df, size).collect()}
    assert got == brute.near_duplicates(rows, size)
    assert len({c for _, c in got.values()}) > 5


def test_a_large_group_of_near_copies_is_one_component(spark):
    r = np.random.default_rng(3)
    text = [f"w{i}" for i in r.integers(0, 400, 200)]
    rows = []
    for i in range(1500):
        own = list(text)
        own[i % 200] = f"x{i}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df, 2).groupBy("component_id").count().collect()
    assert [tuple(g) for g in got] == [(0, 1500)]


def star(copies, changed, seed=5):
    """An original of 400 words, and copies with ``changed`` words of their own."""
    r = np.random.default_rng(seed)
    text = [f"w{i}" for i in r.integers(0, 4000, 400)]
    rows = [(copies // 2, " ".join(text))]
    for i in [i for i in range(copies + 1) if i != copies // 2]:
        own = list(text)
        for at in r.choice(400, changed, replace=False):
            own[at] = f"x{i}-{at}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("copies", [100, 1000, 5000])
def test_copies_of_one_original_are_found_however_many(spark, copies):
    rows = star(copies, 20)
    own = brute.shingle_set(rows[0][1], 2)
    near = [i for i, t in rows if 100 * len(own & (x := brute.shingle_set(t, 2))) >= 80 * len(own | x)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    least = min(near)
    assert len(near) > 0.9 * copies
    assert {r.doc_id for r in got if r.component_id == least} >= set(near)


def test_template_texts_around_the_limit_equal_all_pairs(spark):
    rows = star(300, 24) + [(i + 1000, t) for i, t in star(300, 11, seed=6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df, 2).collect()}
    assert got == brute.near_duplicates(rows, 2)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == (
        {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {8: 8, 9: 8}
    )


# Pages


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>unclosed <i>it", "unclosed it"),
        ("<article><h1>T</h1><script>var a='</p>';</script><p>x<style>p{}</style>y</article>", "T\nxy"),
        ("<body><header>Site</header><nav>a b</nav><div class=content><p>One two<div>three <b>x</b></div>tail<hr>more</div><div class=comments><p>no no no no no no no no no", "One two\nthree x\ntail\nmore"),
        ("<main><p>A &amp; B&nbsp;c &lt;p&gt;&#233;</p><form><p>f</form><aside>s</aside><table><tr><td>1<td>2<tr><td>3</table></main><footer>f</footer>", "A & B c <p>é\n1 2\n3"),
        ("<div id=it's><p>hello world</p></div><div hidden>h</div><!-- c --><div class='cookie-notice'>ok?</div>", "hello world"),
        ("<article><header><h1>Head</h1><span>by me</span></header><p>Text of the article.</p><ul><li>a<li>b</ul></article>", "Head\nText of the article.\na\nb"),
        ("<p>a</p>" * 3 + "<ul>" + "<li><a href=x>link link</a>" * 3 + "</ul>", "a\na\na\nlink link\nlink link\nlink link"),
    ],
)
def test_main_text(page, text):
    assert html.extract(page, [])[0] == text


def test_formulas_are_text():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p></article>"
    assert html.extract(page, [])[0] == "Let x=1 be."


def test_a_minority_layout_is_read_by_its_own(spark):
    """A caption under the host's winning path does not stand for an article elsewhere."""
    usual = "<div class=c1><p>{}</p></div><div class=x><p>short</p></div>"
    other = "<div class=c2><p>a caption</p></div><section class=long><p>" + "word " * 100 + "</p></section>"
    pages = [(i, "https://a.example/x", usual.format("word " * 30)) for i in range(9)] + [(9, "https://a.example/y", other)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_pages(df).collect()}
    assert got[9] == ("word " * 100).strip() and got[0] == ("word " * 30).strip()


@pytest.mark.parametrize(
    "piece", ["<b>x</i>", "<i><p><b>x</i>", "<b>x<hr>", "<li><b>x", "<table><tr><td><b>x", "<p><b>x</p>", "</div><span>", "<dt><i>a<dd>"]
)
def test_very_long_broken_pages_take_linear_time(piece):
    import time

    html.parse(piece * 1000)
    start = time.perf_counter()
    html.parse(piece * 10_000)
    small = time.perf_counter() - start
    page = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    html.extract(page, [])
    assert time.perf_counter() - start < 20 + 40 * small


def test_very_long_and_repeated_pages(spark):
    text = " ".join(f"word{i}" for i in range(60_000))
    page = f"<nav>menu</nav><article><p>{text}</p></article>"
    df = spark.createDataFrame([(1, "http://b.example", page)] * 3 + [(2, None, "")], "page_id long, url string, html string")
    got = html.extract_pages(df).collect()
    assert [r.n_chars for r in got if r.page_id == 1] == [len(text)] * 3 and len(got) == 4


def test_pages_follow_their_host(spark):
    """Where most pages agree, a page whose sidebar is longer is read like the others."""
    usual = "<div class=c1><p>{}</p></div><div class=x><p>short</p></div>"
    odd = "<div class=c7><p>tiny text</p></div><div class=x><p>" + "long " * 40 + "</p></div>"
    pages = [(i, "https://A.example.com/x", usual.format("word " * 30)) for i in range(9)]
    pages += [(9, "http://a.example.com/y?z", odd), (10, "not a url", usual.format("b")), (11, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    got = {r.page_id: r.text for r in html.extract_pages(df).collect()}
    assert got[9] == "tiny text" and got[0] == ("word " * 30).strip() and got[11] == ""
    assert html.extract_pages(df.filter("false")).collect() == []


# Pieces


def test_pieces_of_strange_texts(spark, model):
    import sentencepiece as library_

    library = library_.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [
        None, "", " ", "  two  spaces ", "\n", "a\n\nb\tc\r\nd", "▁ ▁▁x", "日本語 中文 é ñ ﬁ Ａ", "\U0001f600 emoji\U0001f600\U0001f600", "x" * 3000,
        "aaaaaaaaaaabababab " * 9, "if (a == b) {\n    return;\r}\x0c", "\x00\x01", "1234567890" * 30, "Reieren.&&& Ou.$$$ '''\"\"\"",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {i: library.encode(t or "") for i, t in enumerate(texts)}
    for loaded in (sentencepiece.LOADED_UNITS, 0):
        got = {r.doc_id: list(r.ids) for r in sentencepiece.encode(df, model, loaded=loaded).collect()}
        assert got == wanted
    decoded = {r.doc_id: r.text for r in sentencepiece.decode(sentencepiece.encode(df, model), model).collect()}
    assert decoded == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}


def test_viterbi_fold_finds_the_best_path(spark):
    pieces = {"a": 3, "b": 4, "c": 5, "ab": 2, "bc": 1, "abc": 9, "ca": 0, "cab": 6}
    toy = sentencepiece.Model(
        tuple((p, i, -float(cost)) for i, (p, cost) in enumerate(pieces.items())), 100, frozenset(["ab", "bc", "ca"])
    )
    rank = toy.ranks()

    def best(unit):
        costs = {0: (0, [])}
        for end in range(1, len(unit) + 1):
            options = []
            for at in range(end):
                p = unit[at:end]
                if at in costs and p in pieces:
                    options.append((costs[at][0] + rank[-float(pieces[p])], costs[at][1] + [p]))
            if options:
                costs[end] = min(options, key=lambda o: o[0])
        return costs[len(unit)][0]

    units = ["abc", "abcabc", "cabbab", "ccc", "abab", "bcabcab"]
    df = spark.createDataFrame(list(enumerate(units)), "doc_id long, text string")
    lattice = sentencepiece.lattice(df.select(F.col("text").alias("unit"), F.lit(None).cast("string").alias("spelled")), toy)
    borders = sentencepiece.best_borders(F.col("edges"), F.length("unit"))
    names = {i: p for p, i, _ in toy.pieces}
    for row in lattice.select("unit", sentencepiece._ids(borders, toy).alias("ids")).collect():
        assert "".join(names[i] for i in row.ids) == row.unit
        assert sum(rank[-float(pieces[names[i]])] for i in row.ids) == best(row.unit)


# Lines


def test_passages_stay_once(spark):
    short = "\n".join(f"{w} one two three four" for w in WORDS[:14])  # 70 words in short lines
    rows = [
        (1, f"first line\n{PASSAGE}\nlast line"),
        (2, f"{PASSAGE}\nother"),
        (3, f"intro words\n{short}\nend of three"),
        (4, f"{short}\nend of four"),
        (5, f"before\n\n{short}"),
        (6, "two short lines\nthat repeat"),
        (7, "two short lines\nthat repeat"),
        (8, f"{PASSAGE}\n{PASSAGE}"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.report(df).collect()}
    assert got == {
        1: rows[0][1], 2: "other", 3: rows[2][1], 4: "end of four", 5: "before\n", 6: rows[5][1], 7: rows[6][1], 8: "",
    }
    assert sorted(r.doc_id for r in lines.without_repeats(df).collect()) == [1, 2, 3, 4, 5, 6, 7]


def covered(text, runs):
    """Lines of a text that runs of these hashes cover."""
    out = set()
    for first, last, h in lines.runs_of(text):
        if h in runs:
            out.update(range(first, last + 1))
    return out


def short_lines(r, words):
    out, n = [], 0
    while n < words:
        own = int(min(r.integers(1, 7), words - n))
        out.append(" ".join(f"w{i}" for i in r.integers(0, 400, own)))
        n += own
    return out


@pytest.mark.parametrize("seed", range(3))
def test_every_passage_is_covered_wherever_it_stands(seed):
    r = np.random.default_rng(seed)
    for trial in range(1500):
        passage = short_lines(r, int(r.integers(50, 56))) if trial % 5 else [f"the same {trial}"] * 20
        before, after = (short_lines(r, int(r.integers(0, 80))) for _ in range(2))
        text = "\n".join(before + passage + after)
        own = {h for *_, h in lines.runs_of("\n".join(short_lines(r, 30) + passage + short_lines(r, 30)))}
        found = covered(text, own) & set(range(len(before), len(before) + len(passage)))
        # Of one line over and over, a few at an end may be left.
        assert len(found) == len(passage) if trial % 5 else 3 * (len(passage) - len(found)) < 50


def test_passages_of_short_lines_go(spark):
    r = np.random.default_rng(5)
    passages = [short_lines(r, 50 + int(i)) for i in r.integers(0, 30, 40)] + [["a b c"] * 20]
    rows = []
    for i, passage in enumerate(passages * 2):
        rows.append((i, "\n".join(short_lines(r, 25) + passage + short_lines(r, 25)), "s", "en", 0))
    got = {x.doc_id: x.text for x in lines.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert brute.repeated_passages(t for _, t, *_ in rows) and not brute.repeated_passages(got.values())
    # Nothing but the passage goes, and only from the second of each two.
    for i in range(len(passages) - 1):
        assert got[i] == rows[i][1]
        second = rows[i + len(passages)][1].split("\n")
        assert [line for line in second if line not in set(passages[i])] == [
            line for line in got[i + len(passages)].split("\n") if line not in set(passages[i])
        ]


def test_equal_hashes_of_other_lines_are_not_removed():
    found = [{"first": 0, "last": 0, "run_text": PASSAGE}]
    assert lines._cut_text(PASSAGE, found)[0] == ""
    assert lines._cut_text(PASSAGE.upper(), found)[0] == PASSAGE.upper()


# Records


def test_records_are_checked_and_shuffled(spark, tmp_path):
    texts = [(i, " ".join(WORDS[: i % 17])) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    manifest = tokens_file.write_tokens(df, tokens_file.model_text(MODEL), scratch_path(spark, "records"))
    index = tokens_file.read_index(manifest).orderBy("shard", "place").collect()
    assert [r.doc_id for r in index] == list(range(200))
    first, again, other = ([(r.doc_id, list(r.ids)) for r in tokens_file.shuffled_tokens(manifest, seed).collect()] for seed in (1, 1, 2))
    assert first == again != other and sorted(first) == sorted(other)
    assert [d for d, _ in first] != sorted(d for d, _ in first)
    path = manifest.orderBy("shard").first().path.removeprefix("file:") + ".bin"
    with open(path, "r+b") as file:
        file.seek(12)
        byte = file.read(1)
        file.seek(12)
        file.write(bytes([byte[0] ^ 1]))
    with pytest.raises(PySparkException, match="damaged"):
        tokens_file.read_tokens(manifest).collect()


# Licenses


def test_changed_notices_are_found(spark):
    notice = licenses.NOTICES[7][0].split()
    changed = " ".join([*notice[:8], "extra", "words", *notice[8:14], *notice[15:]])
    rows = [
        (1, f"Some words. {changed.title()}!"),
        (2, " ".join(notice[:6])),
        (3, "GNU  General\nPublic-License; the MIT license, cc by by cc by"),
        (4, "gnu general publicl icense"),
        (5, "worK is MİT license with a Kelvin"),
    ]
    got = {r.doc_id: r for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].n_base == 0 and 0.7 <= got[1].score <= 1
    assert got[2].labels == "" and 0 < got[2].score < 0.7
    assert (got[3].n_base, got[3].base_labels, got[3].first_word, got[3].last_word) == (4, "cc-by,gpl,mit", 0, 10)
    assert got[4].n_base == 0
    for doc_id, text in rows:
        n, places = brute.phrase_places(text, licenses.PHRASES)
        assert (got[doc_id].n_words, got[doc_id].n_base) == (n, len(places))


def plain_cover(text, notice, k=3):
    """The share of a notice's words in k-grams that the text has, wherever they stand."""
    own, words = brute.license_words(text), notice.split()
    grams = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
    covered = {i + j for i in range(len(words) - k + 1) if tuple(words[i : i + k]) in grams for j in range(k)}
    return len(covered) / len(words)


def test_grants_are_labelled(spark):
    rows = [
        (1, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
        (2, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice."),
        (3, "Permission to walk here at any hour is granted by the owner of the field, with or without a dog."),
        (4, None),
    ]
    got = {r.doc_id: r for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["isc", "bsd", "", ""]
    for doc_id, text in rows:
        best = max(plain_cover(text, notice) for notice, _ in licenses.NOTICES)
        assert got[doc_id].score == pytest.approx(best)


def test_templates_are_plain_words():
    for text, label in [*licenses.PHRASES, *licenses.NOTICES]:
        assert text == " ".join(brute.license_words(text)) and label


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab▁ 日é\n\U0001f600", min_size=1, max_size=12), max_size=20))
def test_words_are_cut_alike_one_by_one_and_together(words):
    pairs = frozenset({"ab", "ba", "▁a", "日é", "é\U0001f600"})
    units, counts = sentencepiece.Cutter(pairs)(words)
    wanted = [sentencepiece.units_of(w, pairs) for w in words]
    assert units == [u for own in wanted for u in own] and counts.tolist() == [len(own) for own in wanted]


# Language model


def test_no_training_text(spark):
    df = spark.createDataFrame([(i, None) for i in range(3)], "doc_id long, text string")
    scored = ngram_lm.score(df, ngram_lm.train(df.filter("false"))).collect()
    assert [(r.n_tokens, r.n_known) for r in scored] == [(1, 0)] * 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=400), st.integers(0, 61))
def test_elias_fano(values, shift):
    own = np.unique(np.array(values, np.uint64) >> np.uint64(shift))
    packed = EliasFano.build(own)
    assert (packed.get(np.arange(len(own))) == own).all()
    asked = np.concatenate((own, own + np.uint64(1), np.array([0, 2**63], np.uint64)))
    place = {int(v): i for i, v in enumerate(own)}
    assert packed.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


@pytest.mark.parametrize(("n_words", "shards"), [(1, 1), (2, 64), (12, 4), (30, 2), (30, 8), (60, 16), (200, 64)])
def test_small_vocabularies(spark, n_words, shards):
    r = np.random.default_rng(n_words)
    texts = [" ".join(f"w{i}" for i in r.integers(0, n_words, 20)) for _ in range(7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        got = ngram_lm.score(df, ngram_lm.train(df)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plain, _ = brute.language_model(texts, ngram_lm.MU)
    for row in got:
        tokens, known, base, model = plain(texts[row.doc_id])
        assert (row.n_tokens, row.n_known) == (tokens, known)
        assert row.base_score == pytest.approx(base)
        assert abs(row.score - model) <= tokens / ngram_lm.STEPS


def test_arrays_are_read_where_they_cannot_be_mapped(tmp_path, monkeypatch):
    own = [np.arange(1000, dtype="<i8"), np.array([], "<u2"), np.array([7, 9, 11], "<u4")]
    uri = mapped.write_arrays(str(tmp_path), own)
    assert all((a == b).all() for a, b in zip(mapped.map_arrays(uri), own, strict=True))
    remote = mapped.fs.SubTreeFileSystem("/", mapped.fs.LocalFileSystem())

    class Remote:
        from_uri = staticmethod(lambda uri: (remote, uri.removeprefix("/")))

    monkeypatch.setattr(mapped.fs, "FileSystem", Remote)
    assert all((a == b).all() for a, b in zip(mapped.map_arrays(uri), own, strict=True))


def test_a_hot_context_is_spread():
    shards = ngram_lm._pair_shards(np.zeros(1000, "i8"), np.arange(1000), np.full(1000, 10**8), 40)
    assert len(set(shards.tolist())) > 20


# Quality


def test_window_repeats(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [
        (1, " ".join(w)),
        (2, " ".join(w[:10] + w[:10] + w[20:])),
        (3, " ".join(["a"] * 30)),
        (4, " ".join(w[:8] + ["x"] + w[:8])),
        (5, " ".join(w[:7] + ["x"] + w[:7])),
    ]
    got = {r.doc_id: r.n_repeat_words for r in quality.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 20, 3: 30, 4: 16, 5: 0}


def test_junk_goes_and_prose_stays(spark):
    prose = "the cat and the dog of that house is in a garden with trees that are as green as it was by then and on "
    prose_rows = [(i, " ".join(np.random.default_rng(i).permutation(prose.split() * 4).tolist())) for i in range(30)]
    junk = [(100, " ".join(f"{w}###$$$%%%" for w in WORDS * 5)), (101, " | ".join(f"{w}{i}" for i, w in enumerate(WORDS * 5)))]
    got = {r.doc_id: r for r in quality.report(spark.createDataFrame(prose_rows + junk, "doc_id long, text string")).collect()}
    assert all(got[i].kept for i in range(30)) and not got[100].kept and not got[101].kept


LETTERS = {"ru": "абвгдежзиклмнопрст", "it": "abcdefgilmnopqrstuvz", "el": "αβγδεζηθικλμνξοπρσ", "en": "abcdefghiklmnoprstuw"}


@pytest.mark.parametrize("language", ["ru", "it", "el"])
def test_prose_of_another_language_stays(spark, language):
    r = np.random.default_rng(3)

    def text(name, n=93, share=0.3):
        rare = ["".join(r.choice(list(LETTERS[name]), r.integers(4, 9))) for _ in range(n)]
        own = [r.choice(quality.COMMON[name].split()) if name in quality.COMMON and r.random() < share else w for w in rare]
        parts = [own[i : i + 12] for i in range(0, n, 12)]
        return " ".join(" ".join([part[0].capitalize(), *part[1:]]) + "." for part in parts)

    rows = [(i, text("en")) for i in range(80)] + [(100, text(language)), (101, text("en", share=0.0))]
    got = {x.doc_id: x for x in quality.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].kept and got[100].language == (language if language in quality.COMMON else None)
    assert all(got[i].kept for i in range(80)) and not got[101].kept


def test_junk_with_few_frequent_words_or_some_symbols_goes(spark):
    r = np.random.default_rng(11)
    frequent = quality.COMMON["en"].split()

    def text(n, common):
        own = [f"{WORDS[i]}{WORDS[j]}".lower() for i, j in r.integers(0, 17, (n - common, 2))]
        return r.permutation(own + list(r.choice(frequent, common))).tolist()

    rows = [(i, " ".join(text(300, 63))) for i in range(200)]
    rows += [(1000 + n, " ".join(text(300, n))) for n in range(1, 6)]
    for i, share in enumerate((6, 5, 4)):
        own = text(300, 63)
        symbols = r.choice(["#", "$", "%", "&"], len(" ".join(own)) // (share - 1))
        parts = np.array_split(symbols, len(own))
        rows.append((2000 + i, " ".join(w + "".join(x) for w, x in zip(own, parts))))
    # Symbols apart from the words, so that the frequent words stay what they are.
    for i, share in enumerate((6, 5, 4)):
        own = text(300, 63)
        rows.append((3000 + i, " ".join(own) + " " + "#" * (len(" ".join(own)) // (share - 1))))
    got = {x.doc_id: x for x in quality.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].kept for i in range(200))
    assert [i for i, x in got.items() if i >= 1000 and x.kept] == []
    assert all(got[3000 + i].word_distance < quality.MAX_WORD_DISTANCE for i in range(3))
