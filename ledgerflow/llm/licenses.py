"""License scan by diagonal voting.

Every three-word window of a document is joined, by Spark, with the window
positions of the templates.  Position minus template position is the
diagonal; votes are counted per document, template and diagonal.
Neighbouring diagonals of a template (inserted or left-out words shift them)
are merged while they follow one another within ``DRIFT`` words, and a merged
span counts if the distinct template windows it holds, in order, are at least
``COVER`` of the template's.  For the base phrases only a diagonal that holds
every window counts, which is an exact place of the phrase.

Windows are compared by two independent 64-bit hashes.  Templates are the
fixed tables below, of a few kilobytes, and are the broadcast side; the
documents' windows never shuffle, only their matches do.

Defined results: a null or empty text has no words, no labels, score 0; a
text of fewer than three words matches nothing; overlapping places all count;
score is the largest share of a template that is covered (1 for any base
phrase); rows with equal id and text are told apart by nothing and give one
row each with equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

WINDOW = 3
COVER = 0.7
DRIFT = 8
# Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening notices of well-known licenses and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
_GAP = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SECOND_SEED = 1


def words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_GAP).split()


class SecondHashes(common.WordHashes):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, _SECOND_SEED)
        return h


def template_rows(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> list[tuple]:
    """(template, label, is_base, windows, t_pos, h, g) for every window of every template."""
    one, two, rows = common.WordHashes(), SecondHashes(), []
    for k, (phrase, label, is_base) in enumerate([(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in notices.items()]):
        w = words(phrase)
        if len(w) < WINDOW:
            raise ValueError(f"{phrase!r} has fewer than {WINDOW} words")
        h, g = (common.window_hashes(x.of(w), WINDOW).view(np.int64).tolist() for x in (one, two))
        rows += [(k, label, is_base, len(h), i, a, b) for i, (a, b) in enumerate(zip(h, g, strict=True))]
    return rows


def windows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, n_words, pos, h, g): a row for every window, and one with pos -1 for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = common.WordHashes(), SecondHashes()
        for b in common.slices(batches, 64):
            ids, pos, sizes, h, g = [], [], [], [], []
            for i, t in enumerate(common.texts(b, "text")):
                w = words(t)
                n = max(0, len(w) - WINDOW + 1)
                ids.append(np.full(n + 1, i))
                pos.append(np.arange(-1, n))
                sizes.append(np.full(n + 1, len(w)))
                for out, x in ((h, one), (g, two)):
                    out += [np.zeros(1, np.uint64), common.window_hashes(x.of(w), WINDOW)]
            if not ids:
                continue
            rows = pa.array(np.concatenate(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").take(rows), b.column("doc_id").take(rows), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(pos)), pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(g).view(np.int64))],
                ["uid", "doc_id", "n_words", "pos", "h", "g"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return common.map_arrow(rows, f"uid long, doc_id {kind}, n_words long, pos long, h long, g long", run)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(uid, doc_id, n_words, spans): for each row the verified spans, as
    array<struct<label, is_base, first_word, last_word, cover>>."""
    spark = docs.sparkSession
    templates = spark.createDataFrame(template_rows(base, notices), "template int, label string, is_base boolean, windows long, t_pos long, h long, g long")
    joined = windows_of(docs, id_col, text_col).join(F.broadcast(templates), ["h", "g"], "left").where("pos = -1 or template is not null")
    # The matches are few; the row at pos -1 carries each document through.
    joined = common.stored(joined.select("uid", "doc_id", "n_words", "pos", "template", "label", "is_base", "windows", "t_pos"), "votes")
    votes = joined.where("pos >= 0").groupBy("uid", "template", "label", "is_base", "windows", (F.col("pos") - F.col("t_pos")).alias("diagonal")) \
        .agg(F.collect_set("t_pos").alias("held"), F.min("pos").alias("from_pos"), F.max("pos").alias("to_pos"))
    exact = votes.where(F.col("is_base") & (F.size("held") == F.col("windows"))) \
        .select("uid", "label", "is_base", F.col("diagonal").alias("first_word"), (F.col("diagonal") + F.col("windows") + WINDOW - 2).alias("last_word"), F.lit(1.0).alias("cover"))
    line = Window.partitionBy("uid", "template").orderBy("from_pos", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(line)) > DRIFT) | (F.col("from_pos") - F.lag("to_pos").over(line) > DRIFT + WINDOW)
    merged = votes.where("not is_base").withColumn("cut", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("cut").over(line)) \
        .groupBy("uid", "template", "label", "is_base", "windows", "span") \
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("n"), F.min("from_pos").alias("first_word"), (F.max("to_pos") + WINDOW - 1).alias("last_word"))
    fuzzy = merged.where(F.col("n") >= COVER * F.col("windows")).select("uid", "label", "is_base", "first_word", "last_word", (F.col("n") / F.col("windows")).alias("cover"))
    fields = ["label", "is_base", "first_word", "last_word", "cover"]
    spans = exact.unionByName(fuzzy).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("first_word", "last_word", "label", "is_base", "cover"))).alias("spans"))
    empty = F.array().cast("array<struct<first_word:bigint,last_word:bigint,label:string,is_base:boolean,cover:double>>")
    assert len(fields) == 5
    return joined.where("pos = -1").select("uid", "doc_id", "n_words").join(spans, "uid", "left").withColumn("spans", F.coalesce("spans", empty))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8: places and labels of licenses in every document."""
    found = scan(common.table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.is_base)
    starts = F.transform(base, lambda s: s.first_word)
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s.cover)), F.lit(0.0)).alias("score"))
