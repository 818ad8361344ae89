"""Packing tokenised documents into windows by sum-of-squares online placement.

A document's ids and an end id are cut into whole windows and a rest of ``r < window`` ids.  The
rest goes to the fill level ``h`` (0 is a new window) that leaves the sum over all levels of
squared counts of partially filled windows least; a level array holds those counts.  Each Spark
partition packs its own documents in one pass without a shuffle: a window's number is
(partition, window in it).  Of levels that leave an equal sum the fullest is taken, and there the
window touched last.

At the end of a partition open windows keep what was placed in them, and their gaps are filled,
the fullest window's first, by cutting up the emptiest windows; the one that is left over goes into
windows of power-of-two length, which need no padding.  Beyond ``max_open`` open windows (that
bounds a task's memory) the same is done until half of them are left.  So the padding is zero
whatever the lengths, and only the ids of the emptiest windows are placed twice (``moved``).

Ids are those of the tokenizer file through the ``tokenizers`` library.  That library needs more
CPU here than packing may take in all, so texts without the file's special-token strings go through
``tiktoken`` with the ranks and pattern of the same file, which gives the same ids (tested).

Defined results: null and empty texts consist of the end id; repeated rows are packed each;
no document, no piece.  Other columns are dropped, so their names can't clash.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 1024
MAX_OPEN = 8192
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of texts as ``tokenizers`` gives them without adding special tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        # The file writes bytes as printable characters: printable Latin-1 stands for itself,
        # the other bytes follow in order from code point 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {chr(b): b for b in plain}
        of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        self.quick = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.quick.encode_ordinary(text), np.uint32)


@functools.lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    return Tokens(path)


class Packer:
    """Sum-of-squares placement of one partition's documents.

    ``count[h]`` is the number of open windows with ``h`` ids, ``open[h]`` their content: lists of
    (doc_id, start, ids, doc_tokens).  Closed windows' rows gather in ``rows``; ``moved`` counts the
    ids that were placed once more to fill a gap.
    """

    def __init__(self, first_id: int, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.next_id, self.n_open, self.moved = first_id, 0, 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        for start in range(0, n - n % w, w):
            self._close([(doc_id, start, ids[start:start + w], n)])
        if n % w:
            self._place((doc_id, n - n % w, ids[n - n % w:], n))

    def _place(self, piece: tuple) -> None:
        s, c = len(piece[2]), self.count
        # Change of the sum of squares: a window leaves level h, one enters level h + s
        # (none when that fills it); h = 0 takes a new window and leaves no level.
        levels = np.arange(self.window - s + 1)
        cost = 2 * c[levels + s] + 1
        cost[-1] = 0
        cost[1:] += 1 - 2 * c[1:self.window - s + 1]
        usable = c[levels] > 0
        usable[0] = True
        cost[~usable] = np.iinfo(np.int64).max
        h = int(len(cost) - 1 - np.argmin(cost[::-1]))  # ties: the fullest
        pieces = self.open[h].pop() if h else []
        if h:
            c[h] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if h + s == self.window:
            self._close(pieces)
            return
        self.open[h + s].append(pieces)
        c[h + s] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self._fill(keep=self.max_open // 2)

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, n in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def _fill(self, keep: int) -> None:
        """Fill the fullest open windows with the ids of the emptiest until ``keep`` are left."""
        held = [pieces for level in reversed(self.open) for pieces in level]  # the fullest first
        self.count[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        first, last, spare = 0, len(held), []
        while first < last and (spare or last - first > keep):
            pieces = held[first]
            first += 1
            gap = self.window - sum(len(p[2]) for p in pieces)
            while gap and (spare or first < last):
                if not spare:
                    last -= 1
                    spare = held[last][::-1]
                doc_id, start, ids, n = spare.pop()
                if len(ids) > gap:
                    spare.append((doc_id, start + gap, ids[gap:], n))
                    ids = ids[:gap]
                pieces.append((doc_id, start, ids, n))
                gap -= len(ids)
                self.moved += len(ids)
            if gap:
                spare = pieces[::-1]
            else:
                self._close(pieces)
        for pieces in [*held[first:last], *([spare[::-1]] if spare else [])]:
            level = sum(len(p[2]) for p in pieces)
            self.open[level].append(pieces)
            self.count[level] += 1
        self.n_open = int(self.count.sum())

    def end(self) -> None:
        self._fill(keep=0)
        spare = [p for level in self.open for pieces in level for p in reversed(pieces)]  # one window's
        left = sum(len(p[2]) for p in spare)
        self.moved += left
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            pieces = []
            while size:
                doc_id, start, ids, n = spare.pop()
                if len(ids) > size:
                    spare.append((doc_id, start + size, ids[size:], n))
                    ids = ids[:size]
                pieces.append((doc_id, start, ids, n))
                size -= len(ids)
            self._close(pieces)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)], names)


def pack(docs: DataFrame, text: str = "text", tokenizer: str | None = None, end_id: int = 0,
         window: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        tokens = tokens_of(path)
        packer = Packer(TaskContext.get().partitionId() << 33, window, max_open)
        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("_text")):
                packer.add(doc_id, np.append(tokens.ids(x.as_py() or ""), np.uint32(end_id)))
                if len(packer.rows) > 50_000:
                    yield packer.take()
        packer.end()
        yield packer.take()

    return docs.select("doc_id", F.col(f"`{text}`").alias("_text")).mapInArrow(run, PIECES)


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return pack(table(spark, sf_dir, "documents"))
