"""License scans: diagonal voting of word k-grams, with verified spans.

The words of every text are hashed in rolling k-grams; those that some template holds
(a bit map of fixed size decides, so few others stay) are joined to the templates' positions. Position in
the text minus position in the template is the diagonal of a hit. Hits are counted by
diagonal, diagonals closer than ``slack`` are merged (words put in or left out move the
rest of a license to a neighbouring diagonal), and each merged span is verified by aligning its words
with the template. A span without the words that tell its license from others does not count. The share
of the template that aligns is the score.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm import wordhash
from cyclemart.llm.decontamination import Decontamination, align, hashed_words, hit_map, item_grams, seed_passages
from cyclemart.llm.tables import written

#: Well-known wordings, by label. A third entry are the words, in a row, without which a span is another license or none.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2.0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", "apache org licenses"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use"),
    ("cc", "this work is licensed under a creative commons attribution 4.0 international license", "creative commons attribution"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
     "permission notice shall be included"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "permission notice appear"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
     "lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
     "affero general public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("boost", "distributed under the boost software license version 1.0", "boost software license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("mpl", "licensed under the mozilla public license version 2 0", "mozilla public license"),
    *(("cc", f"cc by{kind} {version}", f"cc by{kind} {version}") for kind in ("", " sa", " nc", " nd", " nc sa", " nc nd") for version in ("1 0", "2 0", "2 5", "3 0", "4 0")),
    *(("cc", f"cc by {kind}", f"cc by {kind}") for kind in ("sa", "nc", "nd")),
    ("cc", "licensed under cc by", "cc by"),
    ("cc", "under a cc by license", "a cc by"),
    ("cc", "creative commons attribution", "creative commons attribution"),
    ("cc", "under a creative commons license", "creative commons license"),
    ("cc", "cc0 1 0", "cc0 1 0"),
    ("cc", "licensed under cc0", "under cc0"),
    ("cc", "released under cc0", "under cc0"),
    ("cc", "creative commons zero", "creative commons zero"),
    *((label, f"spdx license identifier {name}", f"identifier {name}") for label, name in (
        ("apache", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("cc", "cc by"), ("cc", "cc0 1 0"), ("gpl", "gpl 2 0"),
        ("gpl", "gpl 3 0"), ("mit", "mit"), ("mpl", "mpl 2 0"),
    )),
)
#: Phrases that give a label wherever their words stand consecutively.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class LicenseScan:
    """A span counts if its hits and its alignment reach ``share`` of the template."""

    gram: int = 3
    slack: int = 4
    share: float = 0.6


def _phrases(phrases):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        wanted = []
        for phrase, label in phrases:
            for words in wordhash.blocks(pa.array([phrase]), wordhash.ALPHANUMERIC):
                n = len(words.starts)
                wanted.append((n, wordhash.gram_hashes(words, n)[0][0], phrase.encode().split(), label))
        for batch in batches:
            size = batch.num_rows
            n_words, n_base = np.zeros(size, np.int64), np.zeros(size, np.int64)
            first, last = [None] * size, [None] * size
            labels: list[set] = [set() for _ in range(size)]
            for words in wordhash.blocks(batch.column(batch.num_columns - 1), wordhash.ALPHANUMERIC):
                n_words[words.first:words.first + len(words.counts)] = words.counts
                starts = np.cumsum(words.counts) - words.counts
                grams = {n: wordhash.gram_hashes(words, n) for n in {w[0] for w in wanted}}
                texts = words.texts
                for n, hashed, parts, label in wanted:
                    hashes, at = grams[n]
                    for i in at[hashes == hashed]:
                        if [words.word(i + k) for k in range(n)] != parts:
                            continue
                        row = int(texts[i]) + words.first
                        place = int(i - starts[texts[i]])
                        n_base[row] += 1
                        first[row] = place if first[row] is None else min(first[row], place)
                        last[row] = place if last[row] is None else max(last[row], place)
                        labels[row].add(label)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                 pa.array([sorted(x) for x in labels], pa.list_(pa.string()))],
                [*batch.schema.names[:-1], "n_words", "n_base", "first_word", "last_word", "base_labels"],
            )

    return scan


def phrase_places(docs: DataFrame, phrases=PHRASES) -> DataFrame:
    """``docs`` without its last column, the text, with n_words, n_base (places of all phrases), first_word and
    last_word (smallest and largest start, words from 0; null if none) and base_labels (distinct, sorted)."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema[:-1])
    return docs.mapInArrow(
        _phrases(phrases), f"{kept}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>"
    )


def _verified(templates, p: LicenseScan):
    """A map over batches of (id, start, passage, spans): (id, label, share) of the spans that count.

    A passage is hashed once and spans are slices of it, so the work is the words of the spans, however many lie in one text.
    Spans of equal words are aligned once a passage, and a label that has its whole template needs no more.
    """
    plain = Decontamination(gap=-1)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hashes = hashed_words(pa.array([t[1] for t in templates], pa.string()))
        needed = hashed_words(pa.array([t[2] if len(t) > 2 else "" for t in templates], pa.string()))
        for batch in batches:
            rows, labels, shares = [], [], []
            starts, spans = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for row, passage in enumerate(hashed_words(batch.column(2))):
                seen, best = set(), {}
                for span in spans[row]:
                    item, label = span["item"], templates[span["item"]][0]
                    words = passage[span["low"] - starts[row]:span["high"] - starts[row] + p.gram]
                    key = item, words.tobytes()
                    if best.get(label) == 1.0 or key in seen:
                        continue
                    seen.add(key)
                    if _holds(words, needed[item]):
                        share = align(hashes[item], words, plain)[0] / (plain.match * len(hashes[item]))
                        best[label] = max(share, best.get(label, 0.0))
                counted = {label: share for label, share in best.items() if share >= p.share}
                rows += [row] * len(counted)
                labels += counted.keys()
                shares += counted.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(labels, pa.string()), pa.array(shares, pa.float64())],
                ["doc_id", "label", "share"],
            )

    return verify


def _holds(words: np.ndarray, row: np.ndarray) -> bool:
    """Whether the words of ``row`` stand in ``words`` one after the other."""
    n = len(words) - len(row) + 1
    if n < 1:
        return False
    found = np.ones(n, bool)
    for i, word in enumerate(row):
        found &= words[i:n + i] == word
    return bool(found.any())


def template_labels(docs: DataFrame, templates=TEMPLATES, p: LicenseScan = LicenseScan()) -> DataFrame:
    """(id, label, score) of the templates found; ``docs``: id and text. One row for each id and label.

    The spans of one passage meet in one row: as many numbers as its words have hits, so no more than its text by a factor
    that the templates set.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, t[1]) for i, t in enumerate(templates)], "item long, item_text string")
    grams = table.mapInArrow(item_grams(p.gram), "item long, place long, n_words long, gram long")
    longest = grams.agg(F.max("n_words")).first()[0] or 0
    shared_map = spark.sparkContext.broadcast(hit_map(grams))
    id_type = docs.schema[0].dataType.simpleString()
    passages = written(
        docs.toDF("doc_id", "text").mapInArrow(
            seed_passages((p.gram,), longest, shared_map),
            f"doc_id {id_type}, start long, passage string, grams array<long>, places array<long>",
        ).withColumn("passage_id", F.monotonically_increasing_id()), "license-passages",
    )
    hits = passages.select("passage_id", F.explode(F.arrays_zip("grams", "places")).alias("hit")).select(
        "passage_id", F.col("hit.grams").alias("gram"), F.col("hit.places").alias("at")
    )
    votes = (
        hits.join(grams, "gram")
        .groupBy("passage_id", "item", "n_words", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    )
    along = Window.partitionBy("passage_id", "item").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > p.slack).cast("int")
    group = F.sum(F.coalesce(apart, F.lit(0))).over(along)
    spans = votes.withColumn("_apart", group).groupBy("passage_id", "item", "n_words", "_apart").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    ).filter(F.col("n") >= p.share * (F.col("n_words") - (p.gram - 1)) - p.slack)
    listed = spans.groupBy("passage_id").agg(F.collect_list(F.struct("item", "low", "high")).alias("spans"))
    scored = passages.join(listed, "passage_id").select("doc_id", "start", "passage", "spans").mapInArrow(
        _verified(tuple(templates), p), f"doc_id {id_type}, label string, share double"
    )
    return scored.groupBy("doc_id", "label").agg(F.max("share").alias("score"))


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, p: LicenseScan = LicenseScan()) -> DataFrame:
    """Licenses named or quoted in each row of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels and labels (comma-joined,
    distinct, sorted; empty if none) and score (0 to 1, the best template's; 0 if none). Null texts
    have no words. Rows that are equal in doc_id and text have equal results.
    """
    docs = docs.select("doc_id", "text")
    row = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    keyed = docs.select(row.alias("row"), "text")
    base = phrase_places(keyed, phrases)
    found = template_labels(keyed, templates, p).groupBy("doc_id").agg(
        F.collect_set("label").alias("_found"), F.max("score").alias("_score")  # at most one entry a label
    )
    found = written(found.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.hash").alias("_hash"), "_found", "_score"), "licenses")
    both = base.join(found, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("row.hash") == F.col("_hash")), "left")
    union = F.array_union("base_labels", F.coalesce("_found", F.array().cast("array<string>")))
    return both.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(F.array_sort(union), ",").alias("labels"),
        F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
