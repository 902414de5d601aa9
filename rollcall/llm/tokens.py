"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

A text is cut before each run of white space. No token of the vocabulary's pattern
crosses such a cut, so the pieces are encoded independently, and each distinct piece
once per worker. Pieces that are a frequent word after one space are read from the
lexicon, a minimal acyclic transducer built from the word counts of all documents;
all others are split by the pattern and merged exactly.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.lexicon import Lexicon, build, name_of
from rollcall.session import checkpoint_dir, local_path, spill

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# fixed values: the vocabulary's published split pattern, and the white space it means
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Distinct pieces a worker remembers, and distinct words it counts before it emits.
_REMEMBERED, _COUNTED = 1_000_000, 500_000
#: Bytes from which a piece is merged by a heap, and letters from which it is not remembered.
_LONG = 128


class Merger:
    """Exact byte-pair merges of single pieces."""

    def __init__(self, path: str):
        import regex

        self.split = regex.compile(PATTERN).findall
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}

    def merge(self, token: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(token)) is not None:
            return [whole]
        return self._merge_long(token) if len(token) > _LONG else self._merge_short(token)

    def _merge_short(self, token: bytes) -> list[int]:
        ranks = self.ranks
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, token: bytes) -> list[int]:
        """The same by a heap of neighbouring pairs, in n log n steps."""
        get, n = self.ranks.get, len(token)
        end = list(range(1, n + 1))  # of the part that starts here; 0 when it was merged into another
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(token[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            # a pair counts only while both its parts are as they were
            if not (mid := end[i]) or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (rank := get(token[i : end[stop]])) is not None:
                    heappush(heap, (rank, i, end[stop]))
            if i and (rank := get(token[(left := before[i]) : stop])) is not None:
                heappush(heap, (rank, left, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[token[i : end[i]]])
            i = end[i]
        return out

    def ids(self, piece: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(self.merge(t.encode()) for t in self.split(piece)))


class _Ids(dict):
    """ids of a piece, filled as pieces are met."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None):
        self.merger, self.lexicon = merger, lexicon

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= _REMEMBERED:
            self.clear()
        if len(piece) > _LONG:
            return self.merger.ids(piece)  # too rare and too large to be kept
        known = self.lexicon.get(piece[1:].encode()) if self.lexicon and piece[0] == " " else None
        self[piece] = ids = self.merger.ids(piece) if known is None else known
        return ids


class _Sizes(dict):
    def __init__(self, merger: Merger):
        self.merger = merger

    def __missing__(self, piece: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        n = len(self.merger.ids(piece))
        if len(piece) <= _LONG:
            self[piece] = n
        return n


_worker: dict = {}  # what a Python worker keeps from task to task


def _kept(key: tuple, make):
    if key not in _worker:
        _worker.clear()
        _worker[key] = make()
    return _worker[key]


def word_counts(df: DataFrame, text: str, words=str.split) -> DataFrame:
    """Rows (word, n) over all texts; each partition counts its own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        emit = lambda: pa.RecordBatch.from_pydict({"word": list(seen), "n": pa.array(seen.values(), pa.int64())})
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(words(t))
            if len(seen) > _COUNTED:
                yield emit()
                seen.clear()
        if seen:
            yield emit()

    return df.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, key: str, most: int) -> list:
    """At most `most` rows of counts (key, n) with the largest n, as a list.

    A histogram of n finds the least n first, so partitions send nothing else. Rows that
    share the last step of the histogram come all or none.
    """
    step = F.floor(F.log2("n") * 16)
    kept = spill(counts.where("n > 1"))
    rows, least = 0, None
    for r in kept.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect():
        rows += r["rows"]
        if rows > most:
            break
        least = r["step"]
    return [] if least is None else kept.where(step >= least).orderBy(F.desc("n"), key).collect()


def compile_lexicon(df: DataFrame, text: str, vocabulary: str, most_words: int = 1 << 15) -> bytes:
    """The lexicon of the most_words most frequent words of all texts.

    most_words bounds what the driver holds; words beyond it are merged when met.
    """
    frequent = most_frequent(word_counts(df, text), "word", most_words)
    merger = Merger(vocabulary)
    return build({r[0].encode(): merger.ids(" " + r[0]) for r in frequent})


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY, most_words: int = 1 << 15) -> DataFrame:
    """Rows (doc_id, ids ARRAY<INT>) of every row of df, without special tokens.

    Strings of special tokens are ordinary text. A null and an empty text have an empty
    list. Repeated and null ids stay as they are; other columns are ignored. The files
    of tokenizers must be at the same path on every machine.
    """
    spark = df.sparkSession
    path = os.path.join(tokenizers, vocabulary)
    block = compile_lexicon(df, text, path, most_words)
    folder = local_path(spark, checkpoint_dir(spark))
    if folder:
        os.makedirs(folder, exist_ok=True)
        shared, mapped = None, os.path.join(folder, name_of(block))
        with open(mapped + ".part", "wb") as f:
            f.write(block)
        os.replace(mapped + ".part", mapped)
    else:
        # no folder that can be memory-mapped: the block is bounded by most_words
        shared, mapped = spark.sparkContext.broadcast(block), name_of(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lambda: Lexicon(shared.value) if shared else Lexicon.mapped(mapped)
        ids = _kept((path, mapped), lambda: _Ids(Merger(path), lexicon()))
        get, pieces = ids.__getitem__, _PIECE.findall
        for batch in batches:
            for part in _slices(batch):
                flat, ends = array("i"), [0]
                for t in part.column(1).to_pylist():
                    if t:
                        flat.extend(chain.from_iterable(map(get, pieces(t))))
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns keep of every row, and n_tokens (0 for a null or empty text)."""
    path = os.path.join(tokenizers, vocabulary)
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _kept((path, "sizes"), lambda: _Sizes(Merger(path)))
        get, pieces = sizes.__getitem__, _PIECE.findall
        for batch in batches:
            n = [sum(map(get, pieces(t))) if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_tokens long"])
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that no output grows past 32-bit offsets."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
