"""Packing of token sequences by minimum bin slack, in one pass without a shuffle.

Every task tokenises its documents, cuts whole windows off long ones and pools what remains.  A
window is filled with the longest remaining piece and the multiset of pooled lengths that comes
closest to the room left: a bitset holds the sums reachable with the lengths so far (bit s is set
when s can be reached), and the stored bitsets are walked back to the counts.  Pieces of one length
are alike, so only counts per length matter.  Where the best sum leaves room, the longest piece left is cut
to fill it, so at most one window a task, its last, is not full.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import text_or_empty

#: Pieces a task pools before it fills windows; bounds memory at POOL * window ids.
POOL = 4096
#: Bytes of words and ids in each of the two generations a worker remembers; bounds memory, not the result.
REMEMBERED_BYTES = 40 << 20
#: Longer words are encoded each time.
REMEMBERED_LENGTH = 64
#: What the tables around a remembered word take.
ENTRY_BYTES = 200
#: Stands between words that are encoded together.  Alone between blanks it is one token, which no word without it contains.
BETWEEN = "~"
#: Words encoded as one text.
JOINED = 256
#: Documents tokenised together.
AT_ONCE = 512


def fill(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, how many) of the pooled lengths whose sum comes closest to ``room`` from below.

    ``counts[l]`` pieces have length l.  Subset sums over a bitset, longest lengths first; a length
    with c pieces is added in doublings (1, 2, 4, ... pieces), so it costs log c shifts.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    goal = 1 << room
    steps: list[tuple[int, int, int]] = []  # length, pieces together, sums reachable before
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left = min(int(counts[length]), room // length)
        together = 1
        while left > 0 and not reach & goal:
            take = min(together, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            together *= 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not (before >> total) & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return list(used.items())


class WordIds:
    """Ids of whole texts by the given tokenizer, with a memory of white-space-free words.

    The tokenizer splits at white space before anything else, so a text's ids are those of its words
    in order.  Only words it has not met are encoded.  Ids are kept as the bytes they are returned in.  When
    the younger generation is full it becomes the older one, whose words come back when they are met again, so
    frequent words stay while rare ones go.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the tokenizer's own would only wait for it.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self.ids(BETWEEN)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        """Encodes words that do not hold ``BETWEEN`` many at a time and cuts the ids at its token."""
        groups = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        for start in range(0, len(groups), 16):
            some = groups[start : start + 16]
            got = self.tokenizer.encode_batch_fast([f" {BETWEEN} ".join(g) for g in some], add_special_tokens=False)
            for group, encoding in zip(some, got, strict=True):
                ids = np.array(encoding.ids, "<u4")
                ends = (np.append(np.flatnonzero(ids == self.between), len(ids)) * 4).tolist()
                data = ids.tobytes()
                cut = map(slice, [0, *[end + 4 for end in ends[:-1]]], ends)
                self.known.update(zip(group, map(data.__getitem__, cut), strict=True))
                self.held += len(data) + sum(map(len, group)) + ENTRY_BYTES * len(group)

    def keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += len(word) + len(ids) + ENTRY_BYTES

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if self.held > REMEMBERED_BYTES:
            self.older, self.known, self.held = self.known, {"": b""}, 0
        met = set(chain.from_iterable(split)).difference(self.known)
        for word in met.intersection(self.older):
            self.keep(word, self.older[word])
        new = list(met.difference(self.known))
        self.learn([w for w in new if BETWEEN not in w])
        for word in new:
            if BETWEEN in word:
                self.keep(word, np.array(self.ids(word), "<u4").tobytes())
        look = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(look, words)), "<u4") for words in split]
        for word in new:
            if len(word) > REMEMBERED_LENGTH:
                self.held -= len(word) + len(self.known.pop(word)) + ENTRY_BYTES
        return out


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Takes documents, gives back rows (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int):
        self.window = window
        self.pool: dict[int, deque] = {}
        self.counts = np.zeros(window + 1, np.int64)
        self.sequence = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.close([(doc_id, start, ids[start : start + self.window], len(ids))])
        if whole < len(ids):
            self.keep((doc_id, whole, ids[whole:], len(ids)))
            while self.counts.sum() > POOL:
                self.step()

    def keep(self, piece: tuple) -> None:
        self.pool.setdefault(len(piece[2]), deque()).append(piece)
        self.counts[len(piece[2])] += 1

    def take(self, length: int) -> tuple:
        self.counts[length] -= 1
        return self.pool[length].popleft()

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            self.rows.append((doc_id, start, ids, tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def step(self) -> None:
        """One window: the longest piece left, the best fill of the room beside it, and a cut piece for what is still free."""
        longest = int(np.flatnonzero(self.counts)[-1])
        pieces = [self.take(longest)]
        for length, many in fill(self.counts, self.window - longest):
            pieces += [self.take(length) for _ in range(many)]
        room = self.window - sum(len(p[2]) for p in pieces)
        if room and self.counts.any():
            doc_id, start, ids, tokens = self.take(int(np.flatnonzero(self.counts)[-1]))
            pieces.append((doc_id, start, ids[:room], tokens))
            self.keep((doc_id, start + room, ids[room:], tokens))
        self.close(pieces)

    def finish(self) -> None:
        while self.counts.any():
            self.step()


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, ids (little-endian unsigned 32-bit), length, doc_tokens, sequence_id, offset per piece.

    Every row of ``docs`` (doc_id, text, ...) is tokenised and ended with ``end_id``; its ids lie in
    pieces that do not overlap, and the pieces of a sequence follow each other from offset 0.  NULL
    or empty text is the end id alone.  Rows that repeat a doc_id are packed each.  sequence_id is
    unique, not gapless: the task's number in its high bits.  Whole texts are tokenised, however long.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        packer = Packer(window)
        base = TaskContext.get().partitionId() << 33

        def rows() -> pa.RecordBatch:
            made = [(d, s, i.tobytes(), len(i), n, base + q, o) for d, s, i, n, q, o in packer.rows]
            packer.rows = []
            columns = zip(*made, strict=True) if made else [()] * len(PIECE)
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, PIECE.types, strict=True)], schema=PIECE)

        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    packer.add(doc_id, np.append(ids, np.uint32(end_id)))
                yield rows()
        packer.finish()
        yield rows()

    return docs.select(F.col("doc_id").cast("long"), text_or_empty()).mapInArrow(
        packed,
        "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long",
    )


#: The rows of ``pack``.
PIECE = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "ids", "length", "doc_tokens", "sequence_id", "offset")]
)
