"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document goes into the window
that it fills best; when it fits none, the fullest window is emitted. What is
open at the end of a task is laid end to end, and the rests of the tasks are
merged in rounds of bounded groups until one is left.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import BYTE_LEVEL_WORDS, NOT_PLAIN, WordCache, held, slices
from tidemark.session import scratch_path

WINDOW = 2048
#: Windows a task keeps open.
OPEN_WINDOWS = 64
#: A window with fewer free places than this is emitted padded; a larger gap
#: is filled with the head of the arriving document.
SLACK = 16
#: Rests merged by one task, at most so many windows.
MERGE_GROUP = 256
#: Characters split into words at once, or one text, and words the tokenizer is asked at once: what it returns is large.
SLICE_CHARS = 500_000
ASKED_WORDS = 4_000
#: Words that begin with a space are asked as texts of so many: most of what a short text costs does not depend on its length.
JOINED_WORDS = 50
#: Words a worker remembers for good; workers of earlier stages live on beside a heap, and each gets some of the tasks.
KEPT_WORDS = 250_000
#: Sequence numbers are task * this + a count from 0.
TASK_STRIDE = 1 << 36

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, rest binary"
)


class _Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0

    def put(self, doc, start: int, ids: bytes, total: int) -> None:
        self.pieces.append((doc, start, ids, total))
        self.used += len(ids) // 4


class Packer:
    """The packing of one task. ``out`` collects finished pieces as rows."""

    def __init__(self, number: int, window: int = WINDOW, keep: int = OPEN_WINDOWS, slack: int = SLACK):
        self.window, self.keep, self.slack = window, keep, slack
        self.open: list[_Window] = []
        self.number, self.out = number, []

    def emit(self, window: _Window, rest: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in window.pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), total, self.number, offset, ids if rest else None))
            offset += n
        self.number += 1

    def add(self, doc, ids: bytes) -> None:
        """Place one document; whole windows of a long one are emitted at once."""
        total, start, step = len(ids) // 4, 0, self.window * 4
        while len(ids) - start >= step:
            full = _Window()
            full.put(doc, start // 4, ids[start : start + step], total)
            self.emit(full)
            start += step
        while start < len(ids):
            n = (len(ids) - start) // 4
            fitting = [w for w in self.open if w.used + n <= self.window]
            if fitting:
                best = max(fitting, key=lambda w: w.used)
                best.put(doc, start // 4, ids[start:], total)
                start = len(ids)
                if best.used == self.window:
                    self.open.remove(best)
                    self.emit(best)
            elif len(self.open) < self.keep:
                self.open.append(_Window())
            else:
                fullest = max(self.open, key=lambda w: w.used)
                gap = self.window - fullest.used
                if gap >= self.slack:
                    fullest.put(doc, start // 4, ids[start : start + 4 * gap], total)
                    start += 4 * gap
                self.open.remove(fullest)
                self.emit(fullest)

    def close(self) -> None:
        """Lay the open windows end to end; the last, partial one is the rest."""
        last = _Window()
        for window in sorted(self.open, key=lambda w: -w.used):
            for doc, start, ids, total in window.pieces:
                while ids:
                    cut = 4 * (self.window - last.used)
                    last.put(doc, start, ids[:cut], total)
                    start, ids = start + cut // 4, ids[cut:]
                    if last.used == self.window:
                        self.emit(last)
                        last = _Window()
        self.open = []
        if last.used:
            self.emit(last, rest=True)

    def rows(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def byte_level_encoder(path: str) -> Callable[[list[str]], Iterator[bytes]]:
    """Texts to little-endian ids, as the tokenizer in ``path`` encodes them.

    Made once in a worker. Texts that hold an added token or characters outside
    PLAIN go to the tokenizer whole; all others are put together from words
    that it has encoded, each distinct one once.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    vocab = tokenizer.get_vocab()
    n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)  # a byte-level token has a character for each byte
    n_bytes[list(vocab.values())] = list(map(len, vocab))
    del vocab

    def original(texts: list[str]) -> Iterator[bytes]:
        for first in range(0, len(texts), ASKED_WORDS):
            found = tokenizer.encode_batch_fast(texts[first : first + ASKED_WORDS], add_special_tokens=False)
            yield from [np.array(e.ids, "<u4").tobytes() for e in found]

    def of_words(words: list[str]) -> list[bytes]:
        """The ids of each word. What begins with a space is split there again, so many words are one text, cut by counted bytes."""
        spaced = [w for w in words if w[0] == " " and not w[-1].isspace()]
        found = {}
        for first in range(0, len(spaced), ASKED_WORDS):
            part = spaced[first : first + ASKED_WORDS]
            texts = ["".join(part[i : i + JOINED_WORDS]) for i in range(0, len(part), JOINED_WORDS)]
            encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in encoded), "<u4")
            del encoded
            token_ends = np.cumsum(n_bytes[ids])
            word_ends = np.cumsum([len(w.encode("utf-8")) for w in part])
            cuts = np.searchsorted(token_ends, word_ends)
            if len(ids) and token_ends[-1] == word_ends[-1] and (token_ends[cuts] == word_ends).all():
                whole, ends = ids.tobytes(), (4 * cuts + 4).tolist()
                found.update(zip(part, [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, original(rest), strict=True))
        return [found[w] for w in words]

    cache = WordCache(of_words, KEPT_WORDS)

    def encode(texts: list[str]) -> Iterator[bytes]:
        for first, last in slices(texts, SLICE_CHARS):
            part = texts[first:last]
            plain = [not NOT_PLAIN.search(t) and not any(a in t for a in added) for t in part]
            words = [BYTE_LEVEL_WORDS.findall(t) if ok else None for t, ok in zip(part, plain, strict=True)]
            cache.learn(w for w in words if w)
            for text, found in zip(part, words, strict=True):
                yield next(original([text])) if found is None else b"".join(map(cache.__getitem__, found))

    return encode


def encoder(path: str) -> Callable[[list[str]], Iterator[bytes]]:
    """The worker's encoder for a vocabulary, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(f"packing {path}", lambda: byte_level_encoder(path))


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()]
    names = [part.split()[0] for part in PIECES.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = WINDOW, keep: int = OPEN_WINDOWS
) -> DataFrame:
    """Pack all texts of (doc_id, text) into sequences of at most ``window`` ids.

    Rows: one per piece with doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A null or empty text is the single id ``end_id``; a
    null doc_id stays null; repeated rows are packed each for itself; an empty
    table gives no rows; other columns are ignored. Only the very last sequence
    and windows with less than SLACK free places are padded.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() * TASK_STRIDE, window, keep)
        encode = encoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in texts]
            for doc, encoded in zip(ids, encode(texts), strict=True):
                packer.add(doc, encoded + end)
            yield _frame(packer.rows())
        packer.close()
        yield _frame(packer.rows())

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["sequence_id", "offset"])
        packer = Packer(int(frame["sequence_id"].iloc[0]), window, keep)
        rest = _Window()
        for row in frame.itertuples(index=False):
            rest.put(None if pd.isna(row.doc_id) else int(row.doc_id), row.start, bytes(row.rest), row.doc_tokens)
        packer.open = [rest]
        packer.close()
        out = pd.DataFrame(packer.rows(), columns=frame.columns)
        return out.astype({"doc_id": "Int64"})

    path = scratch_path(spark, "packed")
    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, PIECES).write.parquet(path)
    parts, rest = [spark.read.parquet(path)], None
    tasks = parts[0].agg(F.max(F.shiftright("sequence_id", 36))).head()[0] or 0
    done = parts[0].where("rest is null")
    rest = parts[0].where("rest is not null")
    groups = tasks + 1
    while groups > 1:
        # a group's numbers start at its smallest one; those are free, as rests keep none of theirs
        groups = -(-groups // MERGE_GROUP)
        path = scratch_path(spark, "packed")
        key = F.pmod(F.xxhash64(F.shiftright("sequence_id", 36)), F.lit(groups))
        rest.groupBy(key.alias("bucket")).applyInPandas(lambda _, f: merge(f), PIECES).write.parquet(path)
        merged = spark.read.parquet(path)
        done = done.unionByName(merged.where("rest is null"))
        rest = merged.where("rest is not null")
    return done.unionByName(rest).drop("rest")
