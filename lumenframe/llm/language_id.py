"""Language identification by code lengths under per-language byte context trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.base import learns, stage, texts
from lumenframe.llm.ppm import Scorer, Tree, gram_counts, grams, summed, text_sums

MAX_GRAMS = 20_000_000  # rows of (language, gram) that a model may have
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
# Unknown languages: code length under the best tree. Letters at random of an alphabet of 26 take 4.7
# bits each, coded data 5 to 6, prose of a known language 2 to 3.5.
MOST_BITS, SPARE_BITS = 4.5, 64.0


def train(docs: DataFrame, *, text: str, lang: str, order: int) -> tuple[list[str], Scorer]:
    """Languages and their trees, from all rows of ``docs`` with a language and a text.

    Counting is distributed; the model has a row per language and distinct gram, a number that
    levels off with the letters in use and is checked against MAX_GRAMS before it is read.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = gram_counts(known.select(F.col(lang).alias("key"), F.col(text).alias("text")), order)
    counts = stage(counts.groupBy("key", "code").agg(F.sum("n").alias("n")), "language-grams")
    if counts.count() > MAX_GRAMS:
        raise ValueError(f"more than {MAX_GRAMS} grams: choose a lower order")
    model = counts.toArrow()
    key = model.column("key").to_pylist()
    langs = sorted(set(key))
    place = {x: i for i, x in enumerate(langs)}
    of = np.fromiter((place[k] for k in key), np.int32, len(key))
    code, n = model.column("code").to_numpy().view(np.uint64), model.column("n").to_numpy()
    trees = [Tree(*(c := summed(code[of == i], n[of == i])), order, summed(c[0] & np.uint64(255), c[1])) for i in range(len(langs))]
    return langs, Scorer(trees)


def predict(docs: DataFrame, model: tuple[list[str], Scorer], *, id: str, text: str) -> DataFrame:
    langs, scorer = model
    held = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by MAX_GRAMS
    order = len(scorer.trees[0].levels) - 1 if langs else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, rows=128):
            code, begin, _ = grams(raw, order)
            sums = text_sums(held.value(code), begin) if langs and raw else np.zeros((len(raw), 1))
            best = sums.argmax(axis=1)
            chance = 1 / np.power(10.0, np.maximum(sums - sums.max(axis=1, keepdims=True), -300)).sum(axis=1)
            sure = [bool(langs) and t is not None and LETTER.search(t.decode()) is not None for t in raw]
            pred = [langs[i] if ok else UNKNOWN for i, ok in zip(best, sure, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(pred, pa.string()), pa.array(np.where(sure, chance, 0.0))], ["id", "lang_pred", "score"]
            )

    flat = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    return flat.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def identify(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", learn: Column | None = None, order: int = 3
) -> DataFrame:
    """The language of each text: the one whose frozen tree gives it the shortest code.

    Every language has a variable-order context tree of bytes with escape probabilities, counted
    over all rows where ``learn`` holds and a language is given. ``score`` is the chance of the
    language against the others, from the code lengths of the whole text.

    Returns one row per input row: ``id``, ``lang_pred``, ``score``. Null texts and texts without
    a letter are "und" with score 0, and so is everything if there is nothing to learn from. Ties
    go to the language that sorts first. Repeated rows, null ids and columns of the same names as
    the results do no harm; an empty table gives an empty result.
    """
    model = train(docs if learn is None else docs.where(learn), text=text, lang=lang, order=order)
    return predict(docs, model, id=id, text=text)


def held_out(id: str = "doc_id") -> Column:
    return ~learns(F.col(id), 4, 2)


def keep_identified(docs: DataFrame, *, text: str = "text", lang: str = "lang", order: int = 3, bits: float = MOST_BITS) -> DataFrame:
    """The documents whose language can be told; their columns are unchanged.

    A document goes if its text is null or has no letter, or if even the tree that suits it best
    needs more than ``bits`` bits a byte (and SPARE_BITS over the whole text besides, so that no
    short text goes for a rare word): no language it knows. Each row is judged by its own text in
    one pass, whatever its id; with nothing to learn from no language is known and all go.
    """
    langs, scorer = train(docs, text=text, lang=lang, order=order)
    held = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by MAX_GRAMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in texts(batches, column=text, rows=128):
            keep = np.zeros(len(raw), bool)
            if langs and raw:
                code, begin, _ = grams(raw, order)
                cost = -text_sums(held.value(code), begin).max(axis=1) / np.log10(2)
                size = np.diff(np.r_[begin, len(code)])
                keep = (cost <= bits * size + SPARE_BITS) & [t is not None and LETTER.search(t.decode()) is not None for t in raw]
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
