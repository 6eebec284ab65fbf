"""Scores of texts by a model of tables, and the counts that such a model is made of, without a row for each term of each text.

Texts are dealt into blocks of some millions of tokens where they are read, and are places in the block's list of distinct
words. These are stemmed once for each block. To be scored, a block's distinct terms fetch their weights by one join, and the
texts meet the weights block by block; to train, a block is one row, which is counted where it was made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from postlark.functions.stemming import stem_all
from postlark.session import stage

if TYPE_CHECKING:
    from postlark.operators.classify import NaiveBayesTables

BLOCK_TOKENS = 4_000_000


def _width(n_terms: int) -> type:
    return np.uint16 if n_terms <= 1 << 16 else np.uint32


def _packed(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Each row's ids as bytes."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


def _pieces(batch: pa.RecordBatch, tokens: int, block_tokens: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """The blocks of a batch: its rows, how many tokens each has, the tokens as places in the list of distinct ones, and this
    list as an array of one list."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(tokens)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // block_tokens
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            piece = batch.slice(a, b - a)
            found = piece.column(tokens).flatten().dictionary_encode()
            distinct = found.dictionary.cast(pa.string())
            ids = found.indices.to_numpy(zero_copy_only=False).astype(_width(len(distinct)))
            yield piece, sizes[a:b], ids, pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct)


def _coder(n_kept: int, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (kept columns, tokens) as rows (kept columns, block, ids) and, for each block, one row that holds its terms."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece, sizes, ids, distinct in _pieces(batch, n_kept, block_tokens):
                names = [*batch.schema.names[:n_kept], "_block", "_ids", "_terms"]
                yield pa.RecordBatch.from_arrays([
                    *piece.columns[:n_kept], pa.array(np.full(len(sizes), block), pa.int64()), _packed(ids, sizes),
                    pa.nulls(len(sizes), distinct.type)], names=names)
                yield pa.RecordBatch.from_arrays([
                    *[pa.nulls(1, c.type) for c in piece.columns[:n_kept]], pa.array([block], pa.int64()), pa.nulls(1, pa.binary()),
                    distinct], names=names)
                block += 1

    return code


def _places_of_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, its list of terms) as rows (block, distinct term, its places in the list): words with one stem are one term."""
    for batch in batches:
        for i in range(batch.num_rows):
            found = batch.slice(i, 1).column(1).flatten().dictionary_encode()
            term_of = found.indices.to_numpy(zero_copy_only=False)
            places = np.argsort(term_of, kind="stable").astype(np.uint32)
            n = len(found.dictionary)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, batch.column(0)[i].as_py()), pa.int64()), found.dictionary.cast(pa.string()),
                _packed(places, np.bincount(term_of, minlength=n))], names=["_of", "term", "_places"])


def _scorer(kept: list[str], classes: tuple[float, ...], priors: list[float]) -> Callable[..., pa.Table]:
    def score(key, texts: pa.Table, weights: pa.Table) -> pa.Table:
        data = b"".join(texts["_ids"].to_pylist())
        places = np.frombuffer(b"".join(weights["_places"].to_pylist()), np.uint32)
        term_of = np.repeat(np.arange(len(weights)), pc.binary_length(weights["_places"]).to_numpy() // 4)
        width = _width(len(places))
        lengths = pc.binary_length(texts["_ids"]).to_numpy().astype(np.int64) // width(0).itemsize
        ids, rows = np.frombuffer(data, width), np.repeat(np.arange(len(lengths)), lengths)
        best_score = best = None
        for i, (label, prior) in enumerate(zip(classes, priors, strict=True)):
            of_word = np.zeros(len(places))
            of_word[places] = weights[f"c_{i}"].to_numpy()[term_of]
            score = np.bincount(rows, of_word[ids], len(lengths)) + prior
            if best is None:
                best_score, best = score, np.full(len(lengths), label)
            else:
                best = np.where(score > best_score, label, best)
                best_score = np.maximum(score, best_score)
        return texts.select(kept).append_column("prediction", pa.array(best, pa.float64()))

    return score


def predict_texts(
    texts: DataFrame, model: NaiveBayesTables, tokens: str, wanted: str, block_tokens: int = BLOCK_TOKENS, stemmed: bool = True,
) -> DataFrame:
    """``texts`` without the column ``tokens`` and with ``prediction``, 0.0 where the column ``wanted`` is false. On a tie the
    lower label wins, as with ``NaiveBayesTables.predict``; rows are written once, and those wanted shuffled once. Unless
    ``stemmed`` the tokens are words, of which each block stems the distinct ones."""
    kept = [c for c in texts.columns if c != tokens]
    fields = [StructField(f.name, f.dataType) for f in texts.select(*kept).schema]
    coded = stage(texts.select(*kept, tokens).mapInArrow(_coder(len(kept), block_tokens), StructType([
        *fields, StructField("_block", LongType()), StructField("_ids", BinaryType()), StructField("_terms", ArrayType(StringType()))])), "coded")
    n = range(len(model.classes))
    listed = coded.filter("_terms is not null").select("_block", F.col("_terms") if stemmed else stem_all("_terms").alias("_terms"))
    terms = listed.mapInArrow(_places_of_terms, "_of bigint, term string, _places binary")
    weights = terms.join(model.products(), "term", "left").select(
        "_of", "_places", *[F.coalesce(f"c_{i}", model.product_of_unknown(i)).alias(f"c_{i}") for i in n])
    priors = {r.label: r.log_prior for r in model.priors.select("label", "log_prior").collect()}
    rows = coded.filter("_terms is null")
    predicted = rows.filter(wanted).drop("_terms").groupBy("_block").cogroup(weights.groupBy("_of")).applyInArrow(
        _scorer(kept, model.classes, [priors[c] for c in model.classes]), StructType([*fields, StructField("prediction", DoubleType())]))
    others = rows.filter(~F.col(wanted)).select(*kept, F.lit(0.0).alias("prediction"))
    return predicted.unionByName(others)


def _word_coder(block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (class, words) as one row for each block: classes, numbers of words and places as bytes, and the distinct words."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, sizes, ids, distinct in _pieces(batch, 1, block_tokens):
                kinds = piece.column(0).to_numpy(zero_copy_only=False).astype(np.int32)
                held = [pa.array([x.tobytes()], pa.binary()) for x in (kinds, sizes, ids)]
                yield pa.RecordBatch.from_arrays([*held, distinct], names=["_kinds", "_sizes", "_ids", "_terms"])

    return code


def _counter(n_classes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The blocks of ``_word_coder``, their words stemmed, as rows (term, df, tf by class)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kinds, sizes, ids = (batch.column(c)[i].as_py() for c in range(3))
                found = batch.slice(i, 1).column(3).flatten().dictionary_encode()
                n, stem_of = len(found.dictionary), found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                terms = stem_of[np.frombuffer(ids, _width(len(stem_of)))]
                sizes = np.frombuffer(sizes, np.int64)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                pairs = np.sort(rows * n + terms)  # much faster than np.unique
                once = np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]
                df = np.bincount(pairs[once] % max(1, n), minlength=n)
                kind_of = np.frombuffer(kinds, np.int32)[rows]
                tf = [np.bincount(terms[kind_of == c], minlength=n) for c in range(n_classes)]
                yield pa.RecordBatch.from_arrays(
                    [found.dictionary.cast(pa.string()), *[pa.array(x, pa.int64()) for x in (df, *tf)]],
                    names=["term", "df", *[f"tf_{c}" for c in range(n_classes)]])

    return count


def class_counts(docs: DataFrame, label: str, classes: Sequence[float], words: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(term, df, tf_0, tf_1, ...), several rows for a term: in how many documents of a block its stem is, and how often in
    those of each class. The words are stemmed once for each block, in the task that reads them."""
    kind = F.coalesce(*[F.when(F.col(label) == c, F.lit(i)) for i, c in enumerate(classes)], F.lit(-1))
    coded = docs.select(kind.alias("_kind"), words).mapInArrow(
        _word_coder(block_tokens), "_kinds binary, _sizes binary, _ids binary, _terms array<string>")
    counted = ", ".join(f"tf_{i} bigint" for i in range(len(classes)))
    return coded.withColumn("_terms", stem_all("_terms")).mapInArrow(_counter(len(classes)), f"term string, df bigint, {counted}")
