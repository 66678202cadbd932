"""Packing of token sequences: a fixed number of open windows per task, best fit, leftovers merged at the end.

Each task reads its documents in order. A document's tokens are its text's, without special tokens, and one end
token. As long as a whole window is left of it, that is a sequence of its own. The rest goes whole into the open
window in which it leaves the least room. Where it fits none, a new window is opened; where `open_windows` are open,
the fullest is emitted: its room is first filled with the head of the document (`cut`), or left as padding.

What is open at the end of a task is left over: a bounded number of windows. Leftovers of `FAN` tasks are packed
again by one task in the same way, round by round, until one task has all that is left. It lays its windows end to
end, and cuts what does not fill the last one at powers of two, as sequences of these lengths need no padding. So
with `cut` nothing is padded.

Token ids are those of the `tokenizers` file with the same vocabulary; they are made by `tiktoken` from its rank
file, which gives the same ids in a quarter of the time (a test compares the two).

Defined cases: null and empty text is just the end token; a null id stays null; repeated rows are packed each on
their own; other columns are not read; no rows give no rows. A very long text is encoded whole by its task, four
bytes a token. Which sequence a piece is in depends on the order of the rows and on how they are split into tasks,
so results are stored once, and a task that runs again reads the same rows in the same order.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import id_and_text, stored, table, text_groups
from tallyshelf.llm.token_counts import PATTERN, VOCABULARY, encoder

WINDOW = 2048
OPEN_WINDOWS = 32
END_TOKEN = 1
FAN = 16
GROUP_BYTES = 4 << 20
BATCH_TOKENS = 1 << 20

#: `sequence_id` is null in pieces left over; `left` then tells the task and the window, as sequence ids do.
PIECES = pa.schema([
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids", pa.binary()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("left", pa.int64()),
])
PIECES_DDL = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, left long"
)
_BYTES = 4  # of a token id, little-endian

Piece = tuple[int | None, int, bytes, int]


class Windows:
    """The open windows of one task. Emitted pieces lie in `out` until they are taken."""

    def __init__(self, size: int, most: int, cut: bool, first_id: int) -> None:
        self.size, self.most, self.cut = size, most, cut
        self.next_id = first_id
        self.out: list[tuple] = []
        self.waiting = 0
        #: (room, window), the fullest first.
        self.rooms: list[tuple[int, int]] = []
        self.pieces: dict[int, list[Piece]] = {}

    def _emit(self, pieces: list[Piece], left: bool = False) -> None:
        offset = 0
        number, self.next_id = self.next_id, self.next_id + 1
        for doc_id, start, ids, doc_tokens in pieces:
            length = len(ids) // _BYTES
            place = (None, None, number) if left else (number, offset, None)
            self.out.append((doc_id, start, length, ids, doc_tokens, *place))
            offset += length
        self.waiting += offset

    def _put(self, at: int, piece: Piece) -> None:
        """Into the window at a place of `rooms`; a window without room is emitted."""
        room, window = self.rooms.pop(at)
        pieces = self.pieces[window]
        pieces.append(piece)
        room -= len(piece[2]) // _BYTES
        if room:
            insort(self.rooms, (room, window))
        else:
            self._emit(self.pieces.pop(window))

    def add(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int) -> None:
        """Place tokens `start` and on of a document."""
        at, n = 0, len(ids) // _BYTES

        def head(length: int) -> Piece:
            return doc_id, start + at, ids[at * _BYTES : (at + length) * _BYTES], doc_tokens

        while n - at >= self.size:
            self._emit([head(self.size)])
            at += self.size
        while at < n:
            best = bisect_left(self.rooms, (n - at, -1))
            if best < len(self.rooms):
                self._put(best, head(n - at))
                return
            if len(self.rooms) < self.most:
                window, self.next_id = self.next_id, self.next_id + 1
                insort(self.rooms, (self.size - (n - at), window))
                self.pieces[window] = [head(n - at)]
                return
            if self.cut:
                room = self.rooms[0][0]
                self._put(0, head(room))
                at += room
            else:
                self._emit(self.pieces.pop(self.rooms.pop(0)[1]))

    def leave(self) -> None:
        """Give out what is open as leftovers."""
        for _, window in self.rooms:
            self._emit(self.pieces.pop(window), left=True)
        self.rooms = []

    def close(self) -> None:
        """Lay all that is open end to end; what does not fill a window is cut at powers of two."""
        queue = [piece for _, window in self.rooms for piece in self.pieces.pop(window)]
        self.rooms = []
        if not self.cut:
            # Whole pieces, the longest first, each into the window that it fills best.
            rest = Windows(self.size, len(queue) + 1, False, self.next_id)
            for piece in sorted(queue, key=lambda p: -len(p[2])):
                rest.add(*piece)
            for _, window in rest.rooms:
                rest._emit(rest.pieces[window])
            self.out += rest.out
            self.waiting += rest.waiting
            self.next_id = rest.next_id
            return
        total = sum(len(p[2]) for p in queue) // _BYTES
        lengths = [self.size] * (total // self.size)
        rest = total % self.size
        lengths += [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
        pieces = iter(queue)
        doc_id, start, ids, doc_tokens = None, 0, b"", 0
        for length in lengths:
            window = []
            while length:
                if not ids:
                    doc_id, start, ids, doc_tokens = next(pieces)
                taken = ids[: length * _BYTES]
                window.append((doc_id, start, taken, doc_tokens))
                ids, start = ids[len(taken) :], start + len(taken) // _BYTES
                length -= len(taken) // _BYTES
            self._emit(window)

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """The emitted pieces as one batch, if there are `least` tokens of them."""
        if self.out and self.waiting >= least:
            columns = zip(*self.out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES
            )
            self.out, self.waiting = [], 0


def _windows(size: int, most: int, cut: bool, round_number: int) -> Windows:
    """Each task numbers its sequences from a start of its own: 2**32 for each of 2**24 tasks."""
    return Windows(size, most, cut, (round_number << 56) | (TaskContext.get().partitionId() << 32))


def _first_round(size: int, most: int, cut: bool, vocabulary: str, pattern: str, end_token: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = encoder(vocabulary, pattern)
        windows = _windows(size, most, cut, 0)
        end = np.array([end_token], "<u4").tobytes()
        for group in text_groups(batches, GROUP_BYTES):
            for doc_id, text in zip(group["doc_id"].to_pylist(), group["text"].to_pylist(), strict=True):
                ids = encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes() + end
                windows.add(doc_id, 0, ids, len(ids) // _BYTES)
                yield from windows.take(BATCH_TOKENS)
        windows.leave()
        yield from windows.take()

    return run


def _next_round(size: int, most: int, cut: bool, round_number: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(size, most, cut, round_number)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True):
                windows.add(*row)
            yield from windows.take(BATCH_TOKENS)
        if last:
            windows.close()
        else:
            windows.leave()
        yield from windows.take()

    return run


def pack_documents(
    docs: DataFrame,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    cut: bool = True,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    end_token: int = END_TOKEN,
) -> DataFrame:
    """Pieces of documents with their token ids: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    `ids` holds little-endian unsigned 32-bit numbers. `start` counts the document's tokens before the piece, `offset`
    those before it in its sequence. Without `cut` only documents longer than a window are cut, and sequences are
    padded. `vocabulary` is a rank file that every executor has.
    """
    first = _first_round(window, open_windows, cut, vocabulary, pattern, end_token)
    packed = stored(id_and_text(docs).mapInArrow(first, PIECES_DDL), "packed")
    rounds = [packed]
    for number in range(1, 64):
        left = packed.filter(F.col("sequence_id").isNull())
        # Windows left over say which task they are from.
        tasks = left.select(F.countDistinct(F.shiftright("left", 32))).first()[0]
        if not tasks:
            break
        to = -(-tasks // FAN)
        merge = _next_round(window, open_windows, cut, number, last=to == 1)
        packed = stored(left.coalesce(to).mapInArrow(merge, PIECES_DDL), "packed")
        rounds.append(packed)
    pieces = rounds[0]
    for frame in rounds[1:]:
        pieces = pieces.union(frame)
    return pieces.filter(F.col("sequence_id").isNotNull()).drop("left")


def q_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
