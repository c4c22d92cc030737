"""Packing token sequences into windows by best fit, longest pieces first.

A document longer than a window is first cut into full windows; what remains of it, and
each shorter document, is one piece. Pieces are dealt out over groups of bounded size by
a hash of the document and the place in it, and every group is packed on its own: the
pieces go, in order of falling length, each into the open window with the least room that
still takes it, or into a new one. A segment tree over the possible amounts of room finds
that window in logarithmic time. Only a group's last windows are left with much padding,
and a group has tens of thousands of pieces.

Ids never move: a piece is (document, start, length) with its checksum, made in the one
pass that tokenises.

Defined results: a null text is empty and has the end id only, which is a piece of length
one. Rows that repeat, also with the same doc_id, are packed once each. An empty table
gives no pieces. Which window a piece gets depends on the pieces alone, not on tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scholarweave.llm import texts, wordcodes
from scholarweave.workspace import materialise

WINDOW = 2048
GROUP_PIECES = 50_000
_GROUP_BITS = 32  # of a sequence's number, within its group

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Windows with room, in a segment tree over the amount of room."""

    def __init__(self, window: int) -> None:
        self._leaves = 1 << window.bit_length()
        self._below = [0] * (2 * self._leaves)  # open windows under each node
        self._by_room: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, change: int) -> None:
        node = self._leaves + room
        while node:
            self._below[node] += change
            node >>= 1

    def add(self, number: int, room: int) -> None:
        self._by_room[room].append(number)
        self._count(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least ``length``: (number, room)."""
        below, node = self._below, self._leaves + length
        while not below[node]:
            # Climb until there is a right neighbour, whose rooms are all larger.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node = 2 * node + (not below[2 * node])
        room = node - self._leaves
        self._count(room, -1)
        return self._by_room[room].pop(), room


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window number, offset in it) of each length; lengths must fall and fit a window."""
    windows, numbers, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = windows.tightest(length)
        if found is None:
            found, used = (used, window), used + 1
        number, room = found
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            windows.add(number, room - length)
    return numbers, offsets


def cut_documents(
    df: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces of all documents (columns of PIECE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordcodes.library_encoder(tokenizer)
        for part, ids, bounds in wordcodes.encoded_slices(batches, encoder, end_id):
            sizes = np.diff(bounds)
            pieces = -(-sizes // window)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            start = window * (np.arange(len(doc)) - texts.starts_of(pieces)[:-1][doc])
            length = np.minimum(window, sizes[doc] - start)
            first = bounds[:-1][doc] + start
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").take(pa.array(doc)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array([wordcodes.crc32(ids[a : a + n]) for a, n in zip(first, length)], pa.int64()),
                "doc_tokens": pa.array(sizes[doc]),
            })

    return texts.id_and_text(df, key, text).mapInArrow(run, PIECE)


def pack_pieces(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset. ``pieces`` should be a stored table: it is counted first.

    The hash that deals out the groups is of document and place, so no document, source
    or length can make a group large, and of a column ``number``, if there is one: where it
    differs from row to row, rows that repeat cannot either.
    """
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    names = [f.split(" ")[0] for f in PIECE.split(", ")]

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([(n, "descending") for n in ("length", "doc_id", "start", "ids_crc32", "doc_tokens")])
        numbers, offsets = best_fit(group["length"].to_pylist(), window)
        base = group["_group"][0].as_py() << _GROUP_BITS
        group = group.select(names).append_column("sequence_id", pa.array(base + np.array(numbers, np.int64)))
        return group.append_column("offset", pa.array(offsets, pa.int64()))

    columns = [F.col(n).cast("bigint").alias(n) for n in names]
    told = ["doc_id", "start", "ids_crc32", *(["number"] if "number" in pieces.columns else [])]
    dealt = pieces.select(*columns, F.pmod(F.xxhash64(*told), F.lit(groups)).alias("_group"))
    return dealt.groupBy("_group").applyInArrow(pack, f"{PIECE}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = cut_documents(df, tokenizer, end_id, window, key, text).withColumn("number", F.monotonically_increasing_id())
    return pack_pieces(materialise(pieces, "pieces"), window)
