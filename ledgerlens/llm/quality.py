"""Quality rules: repetition counts, and how far a text lies from its language.

Only DataFrame functions: no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.text import let, set_aside, stored, total, words

WINDOW = 8
# A text of fewer words is too short for its histograms to mean anything.
MIN_WORDS = 50
# Jensen-Shannon distances (0 to 1, base 2) above which a text is rejected. Where a
# fifth of the words are frequent ones, a text with none of them lies at about 0.33.
# From the histograms of both over sf0.1, against its labels.
MAX_CHAR_DISTANCE = 0.20
MAX_WORD_DISTANCE = 0.30

# Frequent words of each language.
COMMON = {
    "de": "der die und in den das von zu mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in a is that for it was on with as be by this are from at",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au",
    "it": "di e che la il un per non in una sono mi si ho lo ma ti ha le cosa",
    "nl": "de het een en van ik te dat die in niet je is op zijn met voor maar er aan",
    "pl": "nie w i na z do to się że jest o jak a po za co tak od ale czy",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as",
    "ru": "и в не на я что с по это как но он к из у то за от так же",
}
# Fixed value: the letters of the script that most of those words are in.
LATIN = "[A-Za-z]"
# Character classes, by pattern. White space is one more, and the rest another.
CLASSES = {"upper": r"\p{Lu}", "digit": "[0-9]", "symbol": "[#*$%&|<>]"}


def _hash(word: str) -> Column:
    return F.xxhash64(F.lit(word))


def _among(hashes: str, words_: str) -> Column:
    wanted = [_hash(w) for w in words_.split()]
    return F.size(F.filter(hashes, lambda h: h.isin(wanted)))


def _occurrences(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern, -1)) - 1).cast("long")


def _repeat_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes; repeats are
    looked for within one text, where two windows of different words share a
    hash with a chance of about windows**2 / 2**65.
    """

    def joined(h: Column, by: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + by)))

    # Hashes of 2, 4 and 8 words from each place; the last ones hang over the end.
    windows = F.when(
        F.size(hashes) >= WINDOW,
        let(
            let(let(joined(hashes, 1), lambda h: joined(h, 2)), lambda h: joined(h, 4)),
            lambda h: F.slice(h, F.lit(1), F.size(hashes) - WINDOW + 1),
        ),
    )

    def covered(found: Column) -> Column:
        placed = F.sort_array(
            F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        )
        repeated = let(
            placed,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
                    ),
                    lambda e: e["at"],
                )
            ),
        )
        return let(
            repeated,
            lambda at: total(
                F.transform(
                    at,
                    lambda p, i: F.least(
                        F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)
                    ).cast("long"),
                )
            ),
        )

    return let(
        windows,
        lambda w: F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0).cast("long")).otherwise(
            covered(w)
        ),
    )


def measured(docs: DataFrame, *, repeats: bool = True) -> DataFrame:
    """``docs`` with columns ``q_*``: word, symbol, line and repeat counts, and histograms.

    ``language`` is the one of COMMON whose frequent words the text has most of
    (ties: the first by name), null if it has none. ``char_counts`` counts the
    CLASSES and the rest; ``word_counts`` the frequent words of the language and
    all other words; ``foreign``: without a language, and in another script. Null and empty texts count 0 everywhere.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    common = [_hash(w) for w in sorted({w for ws in COMMON.values() for w in ws.split()})]
    # Three projections, each of which uses columns of the one before more than
    # once, so that the optimizer keeps them apart and computes each value once.
    step = docs.withColumn("q_words", words(F.col("text")))
    step = step.withColumns(
        {
            "q_hashes": F.transform("q_words", lambda w: F.xxhash64(w)),
            "q_chars": total(F.transform("q_words", lambda w: F.length(w).cast("long"))),
        }
    ).drop("q_words")
    step = step.withColumn("q_common", F.filter("q_hashes", lambda h: h.isin(common)))
    hits = F.array(
        *[
            F.struct(
                _among("q_common", ws).alias("n"),
                F.lit(-i).alias("order"),
                F.lit(name).alias("name"),
            )
            for i, (name, ws) in enumerate(sorted(COMMON.items()))
        ]
    )
    step = step.withColumn("q_best", F.array_max(hits))
    language = F.when(F.col("q_best.n") > 0, F.col("q_best.name"))
    n_words = F.size("q_hashes").cast("long")
    known = F.coalesce(
        *[
            F.when(
                language == name,
                F.transform(
                    F.array(*[_hash(w) for w in ws.split()]),
                    lambda x: F.size(F.filter("q_common", lambda h: h == x)).cast("long"),
                ),
            )
            for name, ws in sorted(COMMON.items())
        ]
    )
    char_counts = {name: _occurrences(text, pattern) for name, pattern in CLASSES.items()}
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    fields = {
        "n_words": n_words,
        "word_chars": F.col("q_chars"),
        "n_symbols": char_counts["symbol"],
        "language": language,
        "foreign": F.when(language.isNull(), 2 * _occurrences(text, LATIN) < F.col("q_chars")).otherwise(F.lit(False)),
        "char_counts": let(
            F.array(*char_counts.values(), F.length(text) - F.col("q_chars")),
            lambda c: F.concat(c, F.array(F.length(text).cast("long") - total(c))),
        ),
        "word_counts": let(known, lambda k: F.concat(k, F.array(n_words - total(k)))),
    }
    if repeats:
        fields["n_dup_lines"] = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        fields["n_repeat_words"] = _repeat_words(F.col("q_hashes"))
    # Plain columns: out of a struct, the optimizer would compute a histogram
    # anew for each of its bins.
    return step.withColumns({f"q_{name}": value for name, value in fields.items()}).drop(
        "q_hashes", "q_chars", "q_common", "q_best"
    )


def language_references(measures: DataFrame) -> dict[str, dict[str, list[int]]]:
    """Summed histograms of all `measured` texts with MIN_WORDS or more, by language.

    One row per language of COMMON comes to the driver, whatever the input.
    """
    sums = {
        "char_counts": len(CLASSES) + 2,
        "word_counts": max(len(ws.split()) for ws in COMMON.values()) + 1,
    }
    # A condition inside the sums, not a filter: the optimizer would push a
    # filter down to the text and split it again for every use of a column.
    counted = F.col("q_n_words") >= MIN_WORDS
    rows = (
        measures.groupBy("q_language")
        .agg(
            *[
                F.array(
                    *[F.sum(F.when(counted, F.get(f"q_{kind}", F.lit(i)))) for i in range(n)]
                ).alias(kind)
                for kind, n in sums.items()
            ]
        )
        .collect()
    )
    found = {
        row["q_language"]: {kind: [n for n in row[kind] if n is not None] for kind in sums}
        for row in rows
        if row["q_language"] is not None
    }
    return {name: sums for name, sums in found.items() if sum(sums["char_counts"])}


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms: the root of the divergence in bits."""

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def divergence(p: Column) -> Column:
        terms = F.zip_with(
            p, reference, lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2
        )
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))

    return let(
        counts,
        lambda c: let(
            total(c), lambda n: F.when((n > 0) & reference.isNotNull(), divergence(F.transform(c, lambda x: x / n)))
        ),
    )


def judged(measures: DataFrame, references: dict) -> DataFrame:
    """Distances and verdicts for `measured` documents; see `quality`."""

    def rates(name: str, kind: str) -> Column:
        counts = references[name][kind]
        return F.array(*[F.lit(n / sum(counts)) for n in counts])

    def of_language(kind: str) -> Column:
        chosen = F.lit(None).cast("array<double>")
        for name in sorted(references):
            chosen = F.when(F.col("q_language") == name, rates(name, kind)).otherwise(chosen)
        return chosen

    nearest = F.lit(None).cast("double")
    if references:
        nearest = F.array_min(
            F.array(*[_distance(F.col("q_char_counts"), rates(n, "char_counts")) for n in sorted(references)])
        )
    step = measures.withColumns(
        {"q_char_rates": of_language("char_counts"), "q_word_rates": of_language("word_counts")}
    )
    unknown = F.col("q_language").isNull()
    step = step.withColumns(
        {
            "q_char_distance": F.round(
                F.when(unknown, nearest).otherwise(_distance(F.col("q_char_counts"), F.col("q_char_rates"))), 6
            ),
            "q_word_distance": F.round(
                F.when(F.col("q_foreign"), F.lit(None)).when(unknown & (F.col("q_n_words") > 0), 1.0).otherwise(
                    _distance(F.col("q_word_counts"), F.col("q_word_rates"))
                ),
                6,
            ),
        }
    ).drop("q_char_rates", "q_word_rates")
    failed = (F.col("q_n_words") < 20) | (
        F.lit(100) * F.col("q_n_repeat_words") > F.lit(30) * F.col("q_n_words")
    )
    far = (F.col("q_n_words") >= MIN_WORDS) & (
        (F.coalesce(F.col("q_char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE)
        | (F.coalesce(F.col("q_word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE)
    )
    return step.withColumns({"q_base_failed": failed, "q_kept": ~failed & ~far})


def quality(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``q_*`` as in `measured`, distances and verdicts.

    ``base_failed``: under 20 words, or more than 30 % of the words in repeated
    windows. ``kept``: not base_failed, and, for texts of MIN_WORDS or more, a
    character histogram within MAX_CHAR_DISTANCE and a frequent-word histogram
    within MAX_WORD_DISTANCE of the language's reference. A text without any
    frequent word is measured against the nearest reference's characters and
    has word distance 1, or none if most of its letters are of another script
    than LATIN, of which the lists of frequent words know little. Null text counts as empty and fails the base rule.
    Repeated rows are judged alike; an empty table gives an empty result. The
    operator needs only ``text``; its own columns begin with ``q_`` and replace
    any that ``docs`` has by those names.
    """
    references = language_references(measured(docs.select("text"), repeats=False))
    return judged(measured(docs), references)


RESULT = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "language", "char_distance", "word_distance",
]


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, distances and verdicts.

    The texts are read once: the measures, a few hundred bytes a document, are
    stored, and references and verdicts both read those.
    """
    measures = stored(measured(docs.select("doc_id", "text")).drop("text"), "measures")
    scored = judged(measures, language_references(measures))
    return scored.select("doc_id", *[F.col(f"q_{name}").alias(name) for name in RESULT])


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    renamed, back = set_aside(docs, text=F.col("text"))
    # The row number keeps the optimizer from pushing the test below the
    # projections, where it would compute the measures again for each use.
    scored = quality(renamed).withColumn("q_row", F.monotonically_increasing_id())
    return scored.filter(F.col("q_kept") & (F.col("q_row") >= 0)).select(*back)
