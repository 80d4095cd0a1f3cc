"""Licence texts by diagonal voting.

All rolling word k-grams of the documents are joined with the k-grams of known passages. A
common word sequence puts its hits on one diagonal (place in the document minus place in the passage), so hits are
counted by diagonal, neighbouring diagonals (words added or lost) are merged, and each resulting span is verified
word by word against its passage. Short phrases are passages too; they must be there to the letter.
"""

from __future__ import annotations

import difflib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import utf8, written

# Phrases that count as places, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Well-known public licence notices, with their labels.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

PHRASE_GRAM, NOTICE_GRAM = 2, 4
DRIFT = 3  # diagonals this close are one passage with words added or lost
COVERED = 0.6  # of a notice's words that a verified span must have in order
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_INSIDE = B.byte_class(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def passages() -> list[tuple[str, list[str], bool]]:
    """Label, words, and whether it is a phrase, of every passage."""
    phrases = [(label, words_of(text), True) for text, label in PHRASES.items()]
    return phrases + [(label, words_of(text), False) for label, text in NOTICES]


def _words(data: np.ndarray, offsets: np.ndarray) -> B.Words:
    return B.Words(B.LOWER[data], offsets, _INSIDE)


def _gram_hashes(words: B.Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k-gram at every word, and whether it ends in the same row."""
    hashes = B.window_hashes(words.hashes(), length, seed=length)
    full = np.zeros(len(words.start), np.uint64)
    full[: len(hashes)] = hashes
    fits = np.zeros(len(words.start), bool)
    if len(hashes):
        fits[: len(hashes)] = words.row[: len(hashes)] == words.row[length - 1 :]
    return full, fits


def _positions(spark: SparkSession) -> DataFrame:
    """``gram, passage, place``: fixed, a few hundred rows."""
    rows = []
    for i, (_, words, phrase) in enumerate(passages()):
        length = PHRASE_GRAM if phrase else NOTICE_GRAM
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        found, fits = _gram_hashes(_words(data, np.array([0, len(data)])), length)
        rows += [(int(h), i, p) for p, h in enumerate(found[fits].view(np.int64).tolist())]
    return spark.createDataFrame(rows, "gram long, passage int, place int")


def grams(docs: DataFrame) -> DataFrame:
    """``doc, tag, n_words, twos, fours``: hashes of the k-grams from each word on, 0 past a text's end."""

    def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))

    def run(batches):
        for block in B.blocks(batches, "text"):
            words = _words(*B.text_bytes(block.column("text")))
            both = []
            for length in (PHRASE_GRAM, NOTICE_GRAM):
                found, fits = _gram_hashes(words, length)
                both.append(lists(np.where(fits, found, np.uint64(0)), words.first))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc"), block.column("tag"), pa.array(np.diff(words.first)), *both],
                ["doc", "tag", "n_words", "twos", "fours"],
            )

    kind = dict(docs.dtypes)["doc"]
    return docs.mapInArrow(run, f"doc {kind}, tag long, n_words long, twos array<long>, fours array<long>")


def spans(found: DataFrame) -> DataFrame:
    """``doc, tag, passage, start, end, votes``: where hits on neighbouring diagonals add up."""
    spark = found.sparkSession
    known = F.broadcast(_positions(spark))  # a fixed table
    each = found.select("doc", "tag", F.posexplode("twos").alias("at", "gram")).union(
        found.select("doc", "tag", F.posexplode("fours").alias("at", "gram"))
    )
    hits = each.join(known, "gram").select("doc", "tag", "passage", "at", (F.col("at") - F.col("place")).alias("diagonal"))
    votes = hits.groupBy("doc", "tag", "passage", "diagonal").agg(
        F.count_distinct("at").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    own = passages()
    shape = spark.createDataFrame(
        [(i, p, len(w) - (PHRASE_GRAM if p else NOTICE_GRAM) + 1) for i, (_, w, p) in enumerate(own)],
        "passage int, phrase boolean, size int",
    )
    sized = votes.join(F.broadcast(shape), "passage")
    exact = sized.where("phrase AND votes = size").select("doc", "tag", "passage", F.col("diagonal").alias("start"), "high", "votes")
    # a passage's hits in one document are no more than the document's words
    along = Window.partitionBy("doc", "tag", "passage").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True))
    merged = (
        sized.where("NOT phrase").withColumn("group", F.sum(new.cast("int")).over(along))
        .groupBy("doc", "tag", "passage", "group")
        .agg(F.min("low").alias("start"), F.max("high").alias("high"), F.sum("votes").alias("votes"), F.first("size").alias("size"))
        .where(F.col("votes") >= F.col("size") * F.lit(0.3)).select("doc", "tag", "passage", "start", "high", "votes")
    )
    return exact.union(merged)


def _share(passage: list[str], part: list[str]) -> float:
    """Share of the passage's words that the part has in order."""
    matcher = difflib.SequenceMatcher(None, passage, part, autojunk=False)
    return sum(b.size for b in matcher.get_matching_blocks()) / len(passage)


def verified(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc, tag, passage, start, share`` of the spans whose words bear the passage out."""
    listed = written(found.groupBy("doc", "tag").agg(F.collect_list(F.struct("passage", "start", "high")).alias("spans")))
    match = docs["doc"].eqNullSafe(listed["doc"]) & (docs["tag"] == listed["tag"])
    read = docs.join(listed, match).select(docs["doc"], docs["tag"], docs["text"], "spans")
    own = passages()

    def check(text: bytes, spans: list[dict]):
        words = words_of(text.decode("utf-8", "replace"))
        for s in spans:
            _, passage, phrase = own[s["passage"]]
            if phrase:
                share = float(words[s["start"] : s["start"] + len(passage)] == passage)
            else:
                # words before the first and after the last hit may still belong to the passage
                around = len(passage)
                share = _share(passage, words[max(0, s["start"] - around) : s["high"] + NOTICE_GRAM + around])
                share = share if share >= COVERED else 0.0
            if share:
                yield s["passage"], s["start"], share

    def run(batches):
        for block in B.blocks(batches, "text"):
            rows = [
                (d, t, *x)
                for d, t, text, spans in zip(*(block.column(i).to_pylist() for i in range(4)))
                for x in check(text, spans)
            ]
            fields = [("doc", block.column(0).type), ("tag", pa.int64()), ("passage", pa.int32()), ("start", pa.int32()), ("share", pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], [n for n, _ in fields]
            )

    kind = dict(docs.dtypes)["doc"]
    return read.mapInArrow(run, f"doc {kind}, tag long, passage int, start int, share double")


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row with ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base places are phrases to the letter; ``labels`` adds those of notices of which a span has at least ``COVERED`` of
    the words in order. ``score`` is the best share of a verified passage, 0 without any. Label lists are sorted,
    joined by commas, and empty strings where nothing is found; ``first_word`` and ``last_word`` are null then.
    A null text is empty. Repeated rows are scanned once and each gets the result. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    frame = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tag"), utf8(text_col).alias("text"))
    spark = docs.sparkSession
    made = grams(frame)
    own = passages()
    names = spark.createDataFrame([(i, label, p) for i, (label, _, p) in enumerate(own)], "passage int, label string, phrase boolean")
    places = written(verified(frame, spans(made)).distinct()).join(F.broadcast(names), "passage")
    base = F.col("phrase")
    summary = places.groupBy("doc", "tag").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    counts = made.select("doc", "tag", "n_words")
    match = counts["doc"].eqNullSafe(summary["doc"]) & (counts["tag"] == summary["tag"])
    return counts.join(summary, match, "left").select(
        counts["doc"].alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
