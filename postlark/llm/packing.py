"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import sheltered, tie_breaker
from postlark.session import stage

SEQUENCE_TOKENS = 2048
OPEN_BINS = 256
PIECES_PER_GROUP = 4096
END_OF_DOCUMENT = 0
REMEMBERED = 150_000
TEXT_BYTES_AT_ONCE = 4_000_000
# Fixed value: how the vocabulary's tokenizer splits a word, which decides the ids.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at the starts and have the lengths, one after another."""
    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def _coded(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Recent:
    """Remembers what was made of the keys last asked for. When REMEMBERED of them are new, those not asked for since
    the last such turn are forgotten."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, keys: list[str]) -> list[bytes]:
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        fresh = set(keys) - self.new.keys()
        known = fresh & self.old.keys()
        self.new.update((key, self.old[key]) for key in known)
        self.new.update((key, self.make(key)) for key in fresh - known)
        return list(map(self.new.__getitem__, keys))


class WordIds:
    """Token ids of white-space-separated words.

    The tokenizer never joins words across white space, so a text's ids are those of its words in a row. Most of the
    tokenizer's time goes into splitting; here words of Latin letters are normalized and split together by a faster
    engine, and only parts not met lately go to the tokenizer's model. All other words go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT + r"|\n").findall
        self.plain = re.compile(r"[\n\x21-\x7e\xa1-\u024f]*").fullmatch
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level letters stand for themselves
        others = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.parts, self.words = Recent(self._model_ids), Recent(self._tokenizer_ids)

    def _is_plain(self, words: str) -> bool:
        return bool(self.plain(words)) and not any(s in words for s in self.specials)

    def _model_ids(self, part: str) -> bytes:
        if part == "\n":
            return b""
        letters = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        return _coded([t.id for t in self.tokenizer.model.tokenize(letters)])

    def _tokenizer_ids(self, word: str) -> bytes:
        return _coded(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _plain_ids(self, words: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of plain words in a row, and how many each has."""
        if not words:
            return b"", np.zeros(0, np.int64)
        tokens = self.split(unicodedata.normalize("NFC", "\n".join(words)).lower())
        ids = self.parts.of(tokens)
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        breaks = np.flatnonzero(np.fromiter(map("\n".__eq__, tokens), bool, len(tokens)))
        return b"".join(ids), np.diff(np.concatenate([[0], ends[breaks], ends[-1:]]))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all the words, and where each word's begin and how many they are."""
        plain = np.ones(len(words), bool) if self._is_plain("\n".join(words)) else np.array([self._is_plain(w) for w in words], bool)
        flat, counts = self._plain_ids([w for w, p in zip(words, plain, strict=True) if p])
        rest = self.words.of([w for w, p in zip(words, plain, strict=True) if not p])
        lengths, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        lengths[plain], lengths[~plain] = counts, np.array([len(x) // 4 for x in rest], np.int64)
        starts[plain] = np.cumsum(counts) - counts
        starts[~plain] = len(flat) // 4 + np.cumsum(lengths[~plain]) - lengths[~plain]
        return np.frombuffer(flat + b"".join(rest), "<u4"), starts, lengths


_WORDS: dict[str, WordIds] = {}


def _token_ids(texts: pa.Array, words: WordIds) -> Iterator[bytes]:
    """The ids of each text as little-endian 32-bit numbers; texts are worked on some megabytes at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // TEXT_BYTES_AT_ONCE)) + 1 if len(ends) else []
    for begin, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        split = pc.ascii_split_whitespace(pc.fill_null(texts.slice(begin, end - begin), ""))
        offsets = split.offsets.to_numpy()
        coded = pc.dictionary_encode(split.flatten())
        flat, starts, lengths = words.of(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        counts = lengths[codes] if len(codes) else np.zeros(0, np.int64)
        ids = _gathered(flat, starts[codes] if len(codes) else counts, counts)
        places = np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]]
        for i in range(end - begin):
            yield ids[places[i] : places[i + 1]].tobytes()


def _pieces(batches: Iterator[pa.RecordBatch], path: str, text: str, most: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    end, width = np.array([END_OF_DOCUMENT], "<u4").tobytes(), 4 * most
    for batch in batches:
        rows, piece, start, length, crc, kept = [], [], [], [], [], []
        for i, own in enumerate(_token_ids(batch.column(batch.schema.get_field_index(text)), _WORDS[path])):
            ids = own + end
            for k, at in enumerate(range(0, len(ids), width)):
                part = ids[at : at + width]
                rows.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    kept.append(part)
        keys = batch.drop_columns([text]).take(pa.array(rows, pa.int32()))
        made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        made += [pa.array(kept, pa.binary())] if with_ids else []
        names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        yield pa.RecordBatch.from_arrays([*keys.columns, *made], names=[*keys.schema.names, *names])


def tokenized_pieces(docs: DataFrame, tokenizer: str, keys: Sequence[str] = ("doc_id",), text: str = "text",
                     most: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: ``piece`` (from 0), ``start`` (its document's ids before it), ``length``,
    ``ids_crc32`` and, if asked for, ``ids`` (little-endian unsigned 32-bit numbers).

    A document is the ids of its text, then the id 0; only one longer than ``most`` is cut. Null text is empty: the id 0
    alone. ``tokenizer`` is a file that all executors have.
    """
    rows = docs.select(*keys, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)
    schema = f"{kinds}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(lambda batches: _pieces(batches, tokenizer, "_text", most, with_ids), schema)


def best_fit(lengths: Sequence[int], most: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> list[tuple[int, int]]:
    """For each length in turn, the number of its bin and its place there.

    The open bins stand in lists by free space, and a bit for each space tells whether its list holds any: the lowest bit
    at or above a length is the best fit. If none fits and all bins are open, the fullest (the lowest bit) closes. A full
    bin closes by itself.
    """
    free: list[list[int]] = [[] for _ in range(most + 1)]
    bits = count = bins = 0
    out = []
    for n in lengths:
        fitting = bits >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            here = free[space].pop()
            if not free[space]:
                bits ^= 1 << space
            count -= 1
        else:
            if count >= open_bins and n < most:
                fullest = (bits & -bits).bit_length() - 1
                free[fullest].pop()
                if not free[fullest]:
                    bits ^= 1 << fullest
                count -= 1
            here, space = bins, most
            bins += 1
        out.append((here, most - space))
        if space > n:
            if not free[space - n]:
                bits |= 1 << (space - n)
            free[space - n].append(here)
            count += 1
    return out


def _packed(order: Sequence[str], most: int, open_bins: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(list(order), kind="stable")
        placed = best_fit(group["length"].tolist(), most, open_bins)
        first = int(group["_group"].iloc[0]) << 32
        group["sequence_id"] = [first + b for b, _ in placed]
        group["offset"] = [o for _, o in placed]
        return group.drop(columns=["_key", "_group"])

    return pack


def pack(pieces: DataFrame, most: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces, each at most ``most`` long.

    Pieces are dealt by hash into groups of some thousands, whose number grows with them, and each group is packed
    online in a seeded order. The shuffle moves the pieces' rows, so leave out their ids where they are not needed. Equal
    rows are placed apart. Equal runs over equal rows give equal results. Columns called ``sequence_id`` or ``offset``
    are replaced, any other names may be used. No rows give no rows.
    """
    keep = [c for c in pieces.columns if c.lower() not in {"sequence_id", "offset"}]
    inner = sheltered(keep)
    groups = max(1, -(-pieces.count() // PIECES_PER_GROUP))
    keyed = pieces.select(*[F.col(c).alias(inner[c]) for c in keep], tie_breaker(pieces, [c for c in keep if c != "ids"], 5).alias("_key")).withColumn(
        "_group", F.pmod("_key", F.lit(groups)))
    schema = ", ".join(f"`{inner[f.name]}` {f.dataType.simpleString()}" for f in pieces.select(*keep).schema)
    order = ["_key", *[c for c in ("piece", "start") if c in keep]]
    placed = keyed.groupBy("_group").applyInPandas(_packed(order, most, open_bins), f"{schema}, sequence_id bigint, offset bigint")
    return placed.select(*[F.col(inner[c]).alias(c) for c in keep], "sequence_id", "offset")


def packed_documents(docs: DataFrame, tokenizer: str, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Where each piece of each document goes; see tokenized_pieces and pack."""
    return pack(stage(tokenized_pieces(docs, tokenizer, keys, text), "pieces"))
