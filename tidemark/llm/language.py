"""Language identification: known words first, then ever shorter character n-grams.

A word (run of letters, lower-cased) that the model knows scores its log frequency in every
language. A word it has not seen scores the mean log frequency of its known 4-grams, or if it
has none of its 3-grams, and so on down to single letters; the n-grams include the borders of
the word. A text's language is the one with the largest sum over all its words.

The model is fitted on a bounded sample: ``sample_docs`` documents with the smallest hashes of
their ids, of which the ``max_words`` and ``max_grams`` most frequent features are kept. These
bounds make it small enough to be sent to every task. Prediction takes every word of all texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column, ragged, span_hashes, text_chunks
from tidemark.llm.letters import Letters, Lookup

UNDETERMINED = "und"
GRAM_SIZES = (4, 3, 2, 1)
SAMPLE_DOCS = 6_000
MAX_WORDS = 40_000
MAX_GRAMS = 40_000
MAX_LANGUAGES = 400
_FLOOR = 0.5  # what an unseen feature counts for in a language


@dataclass
class Model:
    """Log frequencies of features (rows) per language (columns); the features are hashes."""

    languages: list[str]
    prior: np.ndarray
    words: np.ndarray
    word_scores: np.ndarray
    grams: np.ndarray
    gram_scores: np.ndarray


def _word_hashes(found: Letters) -> np.ndarray:
    return span_hashes(found.codes, found.starts, found.ends)


def _gram_hashes(found: Letters, chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the chosen words with one border place on either side, and
    their number per word."""
    starts = found.starts[chosen] - 1
    counts = np.maximum(found.ends[chosen] + 1 - starts - size + 1, 0)
    if size == 1:
        starts, counts = starts + 1, counts - 2
    places = ragged(starts, counts)
    return span_hashes(found.codes, places, places + size), counts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, kind, feature, n)``; kind 0 is a word, others the n-gram's size."""
    for batch in batches:
        langs, texts = column(batch, "lang").to_pylist(), column(batch, "text")
        for row, end, _, _ in text_chunks(texts):
            found = Letters(texts.slice(row, end - row).to_pylist())
            counts: Counter[tuple[str, int, int]] = Counter()
            for lang in sorted(set(langs[row:end])):
                mine = np.array([x == lang for x in langs[row:end]])[found.text]
                chosen = np.flatnonzero(mine)
                parts = [(0, _word_hashes(found)[chosen])]
                parts += [(k, _gram_hashes(found, chosen, k)[0]) for k in GRAM_SIZES]
                for kind, hashes in parts:
                    values, n = np.unique(hashes, return_counts=True)
                    for v, c in zip(values.view(np.int64).tolist(), n.tolist()):
                        counts[lang, kind, v] += c
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.int64()),
                    pa.array([counts[k] for k in keys], pa.int64()),
                ],
                names=["lang", "kind", "feature", "n"],
            )


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """Fit on the rows of ``labelled`` that have a language and a text.

    Ids that repeat are one choice of the sample. Without such rows the model is empty and
    predicts nothing. More than ``MAX_LANGUAGES`` languages are refused.
    """
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    ids = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs).collect()
    chosen = spark.createDataFrame([(r["id"],) for r in ids], T.StructType([rows.schema["id"]]))
    sample = rows.join(F.broadcast(chosen), "id").select("lang", "text")
    counts = (
        sample.mapInArrow(_features, "lang string, kind int, feature bigint, n bigint")
        .groupBy("lang", "kind", "feature")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES * 8).collect()
    languages = sorted({r["lang"] for r in totals})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    size = {(r["lang"], r["kind"]): r["n"] for r in totals}

    def best(kinds: str, bound: int) -> tuple[np.ndarray, np.ndarray]:
        features = (
            counts.where(kinds)
            .groupBy("feature", "kind")
            .agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "feature")
            .limit(bound)
            .collect()
        )
        scores = np.zeros((len(features), len(languages)), np.float32)
        for i, r in enumerate(features):
            for j, lang in enumerate(languages):
                n = r["by"].get(lang, 0) or _FLOOR
                scores[i, j] = math.log(n / (size.get((lang, r["kind"]), 0) + 1))
        return np.array([r["feature"] for r in features], np.int64).view(np.uint64), scores

    words, word_scores = best("kind = 0", max_words)
    grams, gram_scores = best("kind > 0", max_grams)
    share = np.array([size.get((lang, 0), 0) + 1 for lang in languages], np.float64)
    return Model(languages, np.log(share / max(share.sum(), 1)), words, word_scores, grams, gram_scores)


def text_scores(texts: list[str | None], model: Model, words: Lookup, grams: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """The log score of every text in every language, and its number of words."""
    found = Letters(texts)
    by_word = np.zeros((len(found.starts), len(model.languages)), np.float32)
    at = words(_word_hashes(found))
    by_word[at >= 0] = model.word_scores[at[at >= 0]]
    open_ = np.flatnonzero(at < 0)
    for size in GRAM_SIZES:
        if not len(open_):
            break
        hashes, counts = _gram_hashes(found, open_, size)
        gram = grams(hashes)
        owner = np.repeat(np.arange(len(open_)), counts)[gram >= 0]
        gram = gram[gram >= 0]
        n = np.bincount(owner, minlength=len(open_))
        for j in range(len(model.languages)):
            total = np.bincount(owner, weights=model.gram_scores[gram, j], minlength=len(open_))
            by_word[open_, j] = total / np.maximum(n, 1)
        open_ = open_[n == 0]
    out = np.zeros((len(texts), len(model.languages)))
    for j in range(len(model.languages)):
        out[:, j] = np.bincount(found.text, weights=by_word[:, j], minlength=len(texts))
    return out, np.bincount(found.text, minlength=len(texts))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row; score is the posterior of the prediction.

    A null text, a text without letters and any text under an empty model are ``und`` with
    score 0. Letters of which the model knows none give the most common language. Equal scores
    give the language that sorts first. Repeated rows stay; other columns are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    narrow = docs.select(F.col(id_col), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = shared.value
        words, grams = Lookup(fitted.words), Lookup(fitted.grams)
        names = np.array([*fitted.languages, UNDETERMINED], object)
        for batch in batches:
            texts = column(batch, text_col)
            for row, end, _, _ in text_chunks(texts):
                scores, n = text_scores(texts.slice(row, end - row).to_pylist(), fitted, words, grams)
                pick, posterior = np.full(end - row, len(fitted.languages)), np.zeros(end - row)
                if fitted.languages:
                    scores = scores + fitted.prior
                    some = n > 0
                    pick[some] = scores[some].argmax(axis=1)
                    rest = np.exp(scores[some] - scores[some].max(axis=1, keepdims=True))
                    posterior[some] = 1 / rest.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, id_col).slice(row, end - row),
                        pa.array(names[pick], pa.string()),
                        pa.array(posterior),
                    ],
                    names=[id_col, "lang_pred", "score"],
                )

    schema = T.StructType(
        [narrow.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return narrow.mapInArrow(run, schema)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves that remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))
