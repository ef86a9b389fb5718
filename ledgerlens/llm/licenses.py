"""License scan by diagonal voting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlens.llm.text import let, stored

# Phrases whose every place is reported, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# License notices, of which a part or a changed form counts too.
NOTICES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation",
        "gpl",
    ),
    ("licensed under the apache license version 2 0", "apache-2"),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the"
        " license at http www apache org licenses license 2 0",
        "apache-2",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of"
        " the mpl was not distributed with this file you can obtain one",
        "mpl-2",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    (
        "the software is provided as is without warranty of any kind express or implied including but not limited to"
        " the warranties of merchantability fitness for a particular purpose and noninfringement",
        "mit",
    ),
    (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the software",
        "mit",
    ),
    (
        "redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials provided with the"
        " distribution",
        "bsd",
    ),
    (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        "bsd-3",
    ),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "apache-2",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation",
        "lgpl",
    ),
    (
        "it under the terms of the gnu affero general public license as published by the free software foundation",
        "agpl",
    ),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held"
        " liable for any damages arising from the use of this software",
        "zlib",
    ),
    (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license",
        "boost",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under the creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    (
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to"
        " this work",
        "cc0",
    ),
    (
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        "epl",
    ),
    ("all rights reserved", "all-rights-reserved"),
]
# Words in a k-gram: short ones for phrases, of which every word must stand.
PHRASE_GRAM, NOTICE_GRAM = 2, 3
# A span counts as a notice if this share of the notice's words stands in it.
MIN_COVER = 0.7
# Diagonals this near each other are one span: words put in or left out shift it.
MAX_SHIFT = 3

# Fixed value: what stands between words, once letters are lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Lower case of this letter would be a plain k. Words are only compared with
# plain ones, so any other letter may stand for it.
_KELVIN, _OTHER = "K", "ĸ"


def license_words(text: Column) -> Column:
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_OTHER)))
    return F.filter(F.split(plain, _BETWEEN), lambda w: w != "")


def _grams(words: list[str], k: int) -> list[list[str]]:
    return [words[i : i + k] for i in range(len(words) - k + 1)]


def _gram_hash(gram: list[str]) -> Column:
    parts = [F.xxhash64(F.lit(w)) for w in gram]
    return F.xxhash64(*parts)


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """A row per template position: gram, template, its label and words, position.

    As many rows as the given templates have words: some hundreds.
    """
    rows = []
    for kind, k, templates in (("phrase", PHRASE_GRAM, phrases), ("notice", NOTICE_GRAM, notices)):
        for number, (text, label) in enumerate(templates):
            words = text.split()
            if len(words) < k:
                raise ValueError(f"a {kind} needs {k} words: {text}")
            rows += [
                (" ".join(gram), f"{kind}-{number}", label, kind, len(words), at)
                for at, gram in enumerate(_grams(words, k))
            ]
    return spark.createDataFrame(
        rows, "gram string, template string, label string, kind string, n_template long, at long"
    )


def _hits(templates, k: int) -> Column:
    """Places and words of the k-grams in column l_words that some template has.

    Rolling hashes over l_hashes are thinned by the templates' hashes; the few
    that stay are spelled out, so the join below compares words.
    """
    known = [_gram_hash(g) for g in {tuple(g) for text, _ in templates for g in _grams(text.split(), k)}]
    last = F.size("l_hashes") - k

    def rolling(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))

    places = F.filter(
        F.transform(
            rolling(F.col("l_hashes")),
            lambda x, i: F.when((i <= last) & x.isin(known), i),
        ),
        lambda i: i.isNotNull(),
    )
    return let(
        places,
        lambda found: F.transform(
            found,
            lambda i: F.struct(
                i.cast("long").alias("place"),
                F.array_join(F.slice("l_words", i + 1, F.lit(k)), " ").alias("gram"),
            ),
        ),
    )


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> tuple[DataFrame, DataFrame]:
    """The documents and the license spans in them.

    First: l_row, doc_id, n_words. Second: l_row, kind, label, first_word,
    last_word, cover (the share of the template's words that stand in the span).

    Every k-gram of a text that equals one of a template votes for the diagonal
    place - position. A phrase stands where all its grams are on one diagonal.
    For notices, diagonals that lie within MAX_SHIFT of the next, and whose
    grams do too, are one span. Null and empty texts have no words and no span;
    repeated rows are scanned one by one, told apart by l_row. Only doc_id and
    text are read, so other columns cannot clash.
    """
    prepared = docs.select("doc_id", license_words(F.col("text")).alias("l_words"))
    prepared = prepared.withColumns(
        {"l_hashes": F.transform("l_words", lambda w: F.xxhash64(w)), "n_words": F.size("l_words").cast("long")}
    )
    scanned = stored(
        prepared.select(
            F.monotonically_increasing_id().alias("l_row"),
            "doc_id",
            "n_words",
            F.concat(_hits(phrases, PHRASE_GRAM), _hits(notices, NOTICE_GRAM)).alias("hits"),
        ),
        "license-hits",
    )
    votes = (
        scanned.select("l_row", F.explode("hits").alias("hit"))
        .select("l_row", "hit.place", "hit.gram")
        .join(F.broadcast(template_grams(docs.sparkSession, phrases, notices)), "gram")
        .withColumn("diagonal", F.col("place") - F.col("at"))
    )
    diagonals = votes.groupBy("l_row", "kind", "template", "label", "n_template", "diagonal").agg(
        F.collect_set("at").alias("ats"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
    )
    standing = diagonals.filter(
        (F.col("kind") == "phrase") & (F.size("ats") == F.col("n_template") - PHRASE_GRAM + 1)
    ).select(
        "l_row",
        "kind",
        "label",
        F.col("diagonal").alias("first_word"),
        (F.col("diagonal") + F.col("n_template") - 1).alias("last_word"),
        F.lit(1.0).alias("cover"),
    )
    order = Window.partitionBy("l_row", "template").orderBy("first", "diagonal")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(
        (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > MAX_SHIFT)
        | (F.col("first") - F.max("last").over(before) > NOTICE_GRAM + MAX_SHIFT),
        F.lit(True),
    )
    spans = (
        diagonals.filter(F.col("kind") == "notice")
        .withColumn("starts", starts.cast("int"))
        .withColumn("span", F.sum("starts").over(order))
        .groupBy("l_row", "kind", "template", "label", "n_template", "span")
        .agg(
            F.min("first").alias("first_word"),
            (F.max("last") + NOTICE_GRAM - 1).alias("last_word"),
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.array_distinct(F.flatten(F.collect_list("ats"))),
                        lambda a: F.sequence(a, a + (NOTICE_GRAM - 1)),
                    )
                )
            ).alias("covered"),
        )
        .select(
            "l_row",
            "kind",
            "label",
            "first_word",
            "last_word",
            (F.size("covered") / F.col("n_template")).alias("cover"),
        )
    )
    return scanned.select("l_row", "doc_id", "n_words"), standing.unionByName(spans)


def report(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per document: phrase places, labels, and the largest cover of a template."""
    rows, spans = scan(docs, phrases, notices)
    phrase = F.col("kind") == "phrase"
    found = spans.groupBy("l_row").agg(
        F.count_if(phrase).alias("n_base"),
        F.min(F.when(phrase, F.col("first_word"))).alias("first_word"),
        F.max(F.when(phrase, F.col("first_word"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
        F.array_join(
            F.sort_array(F.collect_set(F.when(F.col("cover") >= MIN_COVER, F.col("label")))), ","
        ).alias("labels"),
        F.max("cover").alias("score"),
    )
    return rows.join(found, "l_row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
