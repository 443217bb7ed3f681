"""Packing: hierarchical multi-length packing of documents into token sequences.

Documents are routed by length to context-size tiers (powers of two). What exceeds the longest
window fills whole windows of it; the rest, or a shorter document, goes to the smallest tier that
holds it. Windows are packed from the longest tier down: a window takes one document of its tier,
then the largest documents of shorter tiers that fit its gap, and then the head of one more
document, cut at the window's end; what is left of that one is routed anew. A task's last tokens,
fewer than the longest window, make a few sequences at smaller powers of two. So every sequence is
full, at a power of two. Sequences of one tier are put into step
groups of `STEP_TOKENS` tokens each, so that every training step has as much to do.

Each task packs its own partition in one pass: it holds `BUFFER_TOKENS` tokens and the documents of
one batch, whatever the partition's size, and nothing is shuffled. Ids start with the partition's
number, so they are unique without a count over all rows. A task that is run again on the same
partition gives the same pieces.

Defined cases: a null or empty text holds the end id alone; a text of any length is cut into as many
pieces as it needs; repeated rows, also with one id, are separate documents, told apart by
`document`; an empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from crewlens.llm.tables import python_ready
from crewlens.llm.tokens import tokens

TIERS = (512, 1024, 2048, 4096)
BUFFER_TOKENS = 1 << 20
STEP_TOKENS = 1 << 15
END_ID = 2

SCHEMA = ("doc_id bigint, document bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, tier int, step_id bigint, ids binary")


class Packer:
    """Takes documents as id arrays and gives rows of SCHEMA."""

    def __init__(self, first_id: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens, self.first_id = tiers, step_tokens, first_id
        # Per tier, (length, arrival) of its waiting rests in order, and the rests themselves.
        self.waiting: list[list[tuple[int, int]]] = [[] for _ in tiers]
        self.rests: dict[int, tuple] = {}
        self.arrivals = self.sequences = self.documents = self.held = 0
        self.steps: dict[int, list[int]] = {}  # per tier: step id, sequences it still takes
        self.next_step = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        document = self.first_id + self.documents
        self.documents += 1
        at, longest = 0, self.tiers[-1]
        while len(ids) - at >= longest:
            self._write(longest, [(doc_id, document, ids, at, longest)])
            at += longest
        if at < len(ids):
            self._route((doc_id, document, ids, at))

    def _route(self, rest: tuple) -> None:
        left = len(rest[2]) - rest[3]
        tier = next(k for k, size in enumerate(self.tiers) if left <= size)
        insort(self.waiting[tier], (left, self.arrivals))
        self.rests[self.arrivals] = rest
        self.arrivals += 1
        self.held += left

    def _take(self, tier: int, index: int) -> tuple:
        left, arrival = self.waiting[tier].pop(index)
        self.held -= left
        return self.rests.pop(arrival)

    def pack(self) -> None:
        """Fill windows until less than one of the shortest is left."""
        for own in reversed(range(len(self.tiers))):
            size = self.tiers[own]
            while self.waiting[own] and self.held >= size:
                room, pieces = size, []
                for tier in range(own, -1, -1):
                    # Of its own tier the longest document, of the others whatever fits, largest first.
                    while room and (fit := bisect_right(self.waiting[tier], (room, self.arrivals))):
                        rest = self._take(tier, fit - 1)
                        pieces.append((*rest, len(rest[2]) - rest[3]))
                        room -= pieces[-1][4]
                if room:  # no waiting document is that short: cut the shortest one
                    tier = next(k for k in range(len(self.tiers)) if self.waiting[k])
                    doc_id, document, ids, at = self._take(tier, 0)
                    pieces.append((doc_id, document, ids, at, room))
                    self._route((doc_id, document, ids, at + room))
                self._write(size, pieces)

    def finish(self) -> None:
        """What is left is less than the longest window: sequences of its binary digits' sizes."""
        self.pack()
        rests = [self._take(tier, len(self.waiting[tier]) - 1)
                 for tier in reversed(range(len(self.tiers))) for _ in range(len(self.waiting[tier]))]
        left = sum(len(ids) - at for _, _, ids, at in rests)
        for size in (1 << bit for bit in reversed(range(left.bit_length())) if left >> bit & 1):
            room, pieces = size, []
            while room:
                doc_id, document, ids, at = rests.pop()
                length = min(room, len(ids) - at)
                pieces.append((doc_id, document, ids, at, length))
                room -= length
                if at + length < len(ids):
                    rests.append((doc_id, document, ids, at + length))
            self._write(size, pieces)

    def _write(self, size: int, pieces: list[tuple]) -> None:
        step = self.steps.get(size)
        if step is None or step[1] == 0:
            self.steps[size] = step = [self.first_id + self.next_step, max(1, self.step_tokens // size)]
            self.next_step += 1
        step[1] -= 1
        sequence, offset = self.first_id + self.sequences, 0
        self.sequences += 1
        for doc_id, document, ids, at, length in pieces:
            self.rows.append((doc_id, document, at, length, len(ids), sequence, offset, size, step[0],
                              ids[at: at + length].astype("<u4").tobytes()))
            offset += length


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit bytes. tokenizer: the path
    of a tokenizer file that every executor has."""
    python_ready(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 33)
        end = np.array([END_ID], np.uint32)
        for frame in frames:
            for doc_id, ids in zip(frame["doc_id"], encoder.encode(list(frame["text"])), strict=True):
                packer.add(None if pd.isna(doc_id) else int(doc_id), np.append(ids, end))
            if packer.held > BUFFER_TOKENS:
                packer.pack()
            if packer.rows:
                yield _frame(packer, names)
        packer.finish()
        if packer.rows:
            yield _frame(packer, names)

    return docs.select("doc_id", "text").mapInPandas(packed, SCHEMA)


def _frame(packer: Packer, names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(packer.rows, columns=names)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    packer.rows = []
    return frame
