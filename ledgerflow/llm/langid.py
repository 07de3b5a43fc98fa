"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1.  For each bit a binary n-gram
classifier is learnt: the log ratio of the letter n-gram distributions of
the languages on either side.  A text's mean log ratio per n-gram is the
margin of that bit; the codeword with the least weighted logistic loss over
all bits is chosen, and a text whose best two codewords are nearly as good is
flagged as ambiguous.

The n-gram counts cover every training row and whole texts.  What reaches
the driver is one count per language and feature slot: at most
``MAX_LANGUAGES * SLOTS`` numbers.

Defined results: null text or no letter gives ``und`` with score 0; with no
learnt language every text gives ``und``; with one, every text with a letter
gives it with score 1; ties go to the language first in alphabetical order;
a null id counts as an empty id for the fold; repeated rows get equal
results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common

SLOTS = 1 << 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 1000
#: Texts are looked at in runs of so many characters, to bound memory.
RUN = 1 << 20
#: Least lead, in mean loss, of the best codeword over the next.
LEAD = 0.01
#: Sharpness with which losses are turned into a score.
SHARPNESS = 6.0
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def features(text: str) -> np.ndarray:
    """Counts by slot of the letter 1- to 3-grams; anything else counts as one gap.
    A gram belongs to the run that it ends in, so runs do not change the counts."""
    total = np.zeros(SLOTS, np.int64)
    text = text.lower()
    before, tail = True, np.empty(0, np.uint64)
    for start in range(0, len(text), RUN):
        codes = np.frombuffer(text[start:start + RUN].encode("utf-32-le", "surrogatepass"), "<u4")
        alpha = letters()[codes]
        new = np.where(alpha, codes, 0)[alpha | np.concatenate(([before], alpha[:-1]))].astype(np.uint64)
        before = alpha[-1]
        for n in ORDERS:
            codes = np.concatenate((tail[max(0, len(tail) - n + 1):], new))
            grams = np.zeros(max(0, len(codes) - n + 1), np.uint64)
            for j in range(n):
                grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + len(grams)] + np.uint64(1)
            if n == 1:
                grams = grams[codes != 0]
            slot = (common.mix(grams + np.uint64(n)) >> np.uint64(64 - int(math.log2(SLOTS)))).astype(np.int64)
            total += np.bincount(slot, minlength=SLOTS)
        tail = np.concatenate((tail, new))[1 - max(ORDERS):]
    return total


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gather(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, slot, n): feature counts of all rows that have text and language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, v in sums.items():
                slot = np.flatnonzero(v)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot.astype(np.int32)), pa.array(v[slot])], ["lang", "slot", "n"])
            sums.clear()

        for b in common.slices(batches):
            for text, lang in zip(common.texts(b, "text"), b.column("lang").to_pylist(), strict=True):
                if lang not in sums:
                    if len(sums) >= 200:
                        yield from flush()
                    sums[lang] = np.zeros(SLOTS, np.int64)
                sums[lang] += features(text)
        yield from flush()

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    return common.map_arrow(rows, "lang string, slot int, n long", count).groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 per language: all two-way splits for up to six languages, else a fixed random dense code."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 6:
        columns = [[1] + [1 if bits >> i & 1 else -1 for i in range(languages - 1)] for bits in range(2 ** (languages - 1) - 1)]
        return np.array(columns, np.int8).T
    width = math.ceil(10 * math.log2(languages))
    for seed in range(1000):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (languages, width))
        apart = (width - code.astype(int) @ code.T.astype(int)) // 2 + width * np.eye(languages, dtype=int)
        if abs(code.sum(0, dtype=int)).max() < languages and apart.min() >= width // 5:
            return code
    raise ValueError(f"no code for {languages} languages")


class Model:
    """Bit classifiers and codewords, learnt from counts by language and slot."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        p = (counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * SLOTS)
        bits = self.code.shape[1]
        self.weights = np.zeros((SLOTS, bits), np.float32)
        self.scale = np.ones(bits)
        self.trust = np.ones(bits)
        if len(languages) > 1:
            for b in range(bits):
                side = self.code[:, b] > 0
                ratio = np.log(p[side].mean(0)) - np.log(p[~side].mean(0))
                self.weights[:, b] = ratio
                expected = self.code[:, b] * (p @ ratio)
                self.scale[b] = max(expected.mean(), 1e-9)
                self.trust[b] = max(expected.min() / self.scale[b], 0.05)

    def losses(self, counts: np.ndarray) -> np.ndarray:
        margin = counts.astype(np.float32) @ self.weights / max(1, counts.sum()) / self.scale
        loss = np.logaddexp(0, -2 * self.code * margin[None, :])
        return loss @ self.trust / self.trust.sum()

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the choice is ambiguous."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = self.losses(features(text))
        share = np.exp(-SHARPNESS * (loss - loss.min()))
        best = int(loss.argmin())
        return self.languages[best], float(share[best] / share.sum()), bool(np.partition(loss, 1)[1] - loss[best] < LEAD)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    counts = common.stored(gather(docs, text_col, lang_col), "language-counts")
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    rows = counts.toArrow()
    matrix = np.zeros((len(languages), SLOTS), np.int64)
    at = {x: i for i, x in enumerate(languages)}
    which = np.fromiter((at[x] for x in rows.column("lang").to_pylist()), np.int64, count=rows.num_rows)
    matrix[which, rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return Model(languages, matrix)


def predict(model: Model, text: Column) -> Column:
    """struct(lang_pred, score, ambiguous) of each text."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            yield pd.DataFrame([model.predict(t or "") for t in s], columns=["lang_pred", "score", "ambiguous"])

    return run(text)


def training_fold(id_col: str = "doc_id") -> Column:
    return common.crc_mod(id_col, 5) != 0


def identified(docs: DataFrame) -> DataFrame:
    """All columns of the documents, with the struct ``found``."""
    common.workers_import(docs.sparkSession)
    model = learn(docs.where(training_fold()))
    return docs.withColumn("found", predict(model, F.col("text")))


def with_language(docs: DataFrame) -> DataFrame:
    """The documents, as they are, without those whose language is undetermined or ambiguous."""
    common.workers_import(docs.sparkSession)
    model = learn(docs.where(training_fold()))
    found = docs.select(common.whole_row(docs), predict(model, F.col("text")).alias("found"))
    return found.where((F.col("found.lang_pred") != UNDETERMINED) & ~F.col("found.ambiguous")).select("row.*")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op9: the predicted language of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identified(docs).select("doc_id", (~training_fold()).alias("held_out"), "found.lang_pred", "found.score", "found.ambiguous")
