"""SentencePiece encoding and decoding (BPE with byte fallback) by vectorised merge rounds.

A text's spaces become '▁' and one '▁' stands before it, as the model asks. Texts are then flat numpy
arrays of symbols, cut into words where no merge can reach across; each distinct word of a block is
encoded once. In a round every word merges its pair of least rank (best score), at all its places
from the left, and the arrays are compacted; words without a pair leave. Rounds end with the last
pair.

What the library does one merge at a time comes out the same:

* places of one rank merge at once only if no piece that the new one is part of ranks before it;
  else only the leftmost merges, and the next round decides anew;
* in a long word a pair also merges if no better one lies within the length of the longest piece,
  as a merge further away cannot reach it. So rounds do not grow with the length of a word.

Characters that are no piece become the pieces of their bytes. Decoding turns '▁' into spaces, drops
the one that stands before the text, and bytes that are no UTF-8 become U+FFFD each; bytes on both
sides of a control piece are not put together.

Defined cases: a null or empty text has no ids, and no ids are the empty text; rows are independent,
so repeated rows, null ids and ties need no rule; an empty table gives an empty result; columns
besides doc_id and text (or ids) are ignored. '▁' in a text is a space after decoding, as in the
library. Models that normalise texts or hold unused pieces are refused.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crewlens.llm.tables import python_ready

SPACE = "▁"
BLOCK_CHARS = 1 << 20
KNOWN_WORDS = 300_000
LONG_WORD = 64
NONE = np.iinfo(np.int32).max
CODES = 0x110000

# The library replaces each byte of a broken sequence on its own.
codecs.register_error("each_byte", lambda error: ("�", error.start + 1))


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def _runs(heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions head, head + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(heads - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _least_before(ranks: np.ndarray, reach: int) -> np.ndarray:
    """The least of at least `reach` values before each."""
    least, width = ranks.copy(), 1
    while width < reach:
        least[width:] = np.minimum(least[width:], least[:-width].copy())
        width *= 2
    return np.append(np.int32(NONE), least[:-1]).astype(np.int32)


class Pieces:
    """encode(texts): ids of each text; decode(lists of ids): texts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        probe = " a  ﬁ\t"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE) or any(map(model.is_unused, range(size))):
            raise ValueError("The model normalises texts or holds unused pieces.")
        pieces = [model.id_to_piece(i) for i in range(size)]
        names = {p: i for i, p in enumerate(pieces)
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.bytes = np.zeros(256, np.int32)
        self.written = [p.replace(SPACE, " ").encode() for p in pieces]
        self.spaced = np.array([p in names and p.startswith(SPACE) for p in pieces])
        self.silent = np.zeros(size, bool)
        for i in range(size):
            if model.is_byte(i):
                value = int(pieces[i][3:-1], 16)
                self.bytes[value], self.written[i] = i, bytes([value])
            elif model.is_control(i):
                self.written[i], self.silent[i] = b"", True
            elif model.is_unknown(i):
                self.written[i] = model.decode([i]).encode()
        if not self.bytes.any():
            raise ValueError("The model has no byte pieces.")

        # Symbols: a piece's id, or for a character that is no piece its code after all ids.
        self.size, self.base = size, size + CODES
        self.of_code = np.arange(size, size + CODES, dtype=np.int32)
        for piece, i in names.items():
            if len(piece) == 1:
                self.of_code[ord(piece)] = i
        _, ranks = np.unique([-model.get_score(i) for i in range(size)], return_inverse=True)

        def symbol(part: str) -> int | None:
            return names.get(part, size + ord(part) if len(part) == 1 else None)

        merges, inner = {}, set()
        alone = np.zeros(ranks.max() + 1, bool)
        for piece, i in names.items():
            inner.update(zip(piece, piece[1:], strict=False))
            for k in range(1, len(piece)):
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left is not None and right is not None:
                    merges[left * self.base + right] = i
                    for part in (left, right):
                        if part < size and len(pieces[part]) > 1 and ranks[i] <= ranks[part]:
                            alone[ranks[part]] = True
        self.pairs = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[p] for p in self.pairs.tolist()], np.int32)
        self.ranks = ranks[self.merged].astype(np.int32)
        self.alone = alone
        self.inner = np.array(sorted(ord(a) * CODES + ord(b) for a, b in inner), np.int64)
        self.reach = max(map(len, names))
        # Words start at spaces, if no piece holds a space after something else.
        self.cuts = not any(b == SPACE and a != SPACE for a, b in inner)
        # Two generations: what is not met during a whole one is forgotten.
        self.known: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    # -- encoding ----------------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Texts are handled in blocks, long ones cut between words, to bound the memory."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        block, owners, held = [], [], 0
        for owner, text in enumerate(texts):
            if not text:
                continue
            text, at = SPACE + text.replace(" ", SPACE), 0
            while at < len(text):
                upto = min(len(text), at + BLOCK_CHARS) if self.cuts else len(text)
                while upto < len(text) and not (text[upto] == SPACE != text[upto - 1]):
                    upto += 1
                block.append(text[at:upto])
                owners.append(owner)
                held += upto - at
                at = upto
                if held >= BLOCK_CHARS:
                    self._add(block, owners, found)
                    block, owners, held = [], [], 0
        if block:
            self._add(block, owners, found)
        none = np.empty(0, np.int32)
        return [none if not f else f[0] if len(f) == 1 else np.concatenate(f) for f in found]

    def _add(self, block: list[str], owners: list[int], found: list[list[np.ndarray]]) -> None:
        for owner, ids in zip(owners, self._block(block), strict=True):
            found[owner].append(ids)

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.cumsum([0, *map(len, texts)])
        first = np.zeros(len(codes), bool)
        if self.cuts:
            spaces = codes == ord(SPACE)
            first[1:] = spaces[1:] & ~spaces[:-1]
        first[bounds[:-1]] = True
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(codes)))
        place = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
        mixed = (codes + (place << np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        words, at, place = np.unique(np.add.reduceat(mixed, starts), return_index=True, return_inverse=True)
        encoded = self._known(words.tolist(), codes, starts[at], lengths[at])
        flat = np.frombuffer(b"".join(encoded), np.int32)
        sizes = np.array([len(e) // 4 for e in encoded], np.int64)
        counts = sizes[place]
        ids = flat[_runs((np.cumsum(sizes) - sizes)[place], counts)]
        ends = np.append(0, np.cumsum(counts))
        return np.split(ids, ends[np.searchsorted(starts, bounds[1:-1])])

    def _known(self, words: list[int], codes, starts, lengths) -> list[bytes]:
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for k, word in enumerate(words):
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.append(k)
        if new:
            sizes = lengths[new]
            ids, counts = self.merge_rounds(codes[_runs(starts[new], sizes)], np.cumsum(sizes) - sizes)
            flat, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            for k, a, b in zip(new, [0, *ends], ends, strict=False):
                known[words[k]] = flat[a:b]
        return [known[word] for word in words]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of pairs of symbols; NONE for those that do not merge."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE).astype(np.int32), self.merged[at]

    def merge_rounds(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """codes: characters of words one after the other, starts: where each begins. Their ids, and
        how many each has."""
        total = len(codes)
        symbols, at = self.of_code[codes], np.arange(total)
        # A word is cut further between characters that no piece holds next to each other.
        cut = np.ones(total, bool)
        key = codes[:-1].astype(np.int64) * CODES + codes[1:]
        near = np.minimum(np.searchsorted(self.inner, key), len(self.inner) - 1)
        cut[1:] = self.inner[near] != key if len(self.inner) else True
        cut[starts] = True
        word = np.cumsum(cut)
        ranks, merged = np.full(total, NONE, np.int32), np.zeros(total, np.int32)
        ranks[:-1], merged[:-1] = self._pairs(symbols[:-1], symbols[1:])
        ranks[:-1][cut[1:]] = NONE
        out = np.full(total, -1, np.int64)
        while len(symbols):
            begin = _starts(word)
            least = np.minimum.reduceat(ranks, begin)
            sizes = np.diff(np.append(begin, len(symbols)))
            going = least != NONE
            if not going.all():
                stay = np.repeat(going, sizes)
                out[at[~stay]] = symbols[~stay]
                symbols, at, word, ranks, merged = (x[stay] for x in (symbols, at, word, ranks, merged))
                least, sizes = least[going], sizes[going]
                if not len(symbols):
                    break
            chosen = self._chosen(ranks, np.repeat(least, sizes), word, int(sizes.max()))
            symbols[chosen] = merged[chosen]
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            chosen = (np.cumsum(stay) - 1)[chosen]
            symbols, at, word, ranks, merged = (x[stay] for x in (symbols, at, word, ranks, merged))
            new = np.unique(np.concatenate([chosen, chosen[chosen > 0] - 1]))
            ahead = np.minimum(new + 1, len(symbols) - 1)
            found, becomes = self._pairs(symbols[new], symbols[ahead])
            ranks[new] = np.where((ahead == new) | (word[new] != word[ahead]), NONE, found)
            merged[new] = becomes
        counts = self._sizes(out)
        return self._ids(out), np.add.reduceat(counts, starts) if len(starts) else counts

    def _chosen(self, ranks: np.ndarray, least: np.ndarray, word: np.ndarray, longest: int) -> np.ndarray:
        """Left places of the pairs that merge in this round."""
        hit = ranks == least
        alone = np.zeros(len(ranks), bool)
        real = ranks != NONE
        alone[real] = self.alone[ranks[real]]
        if longest > LONG_WORD:
            before, after = _least_before(ranks, self.reach), _least_before(ranks[::-1], self.reach)[::-1]
            top = real & (ranks <= after) & np.where(alone, ranks < before, ranks <= before)
        # Pairs of one rank next to each other share symbols: every other one, from the left.
        same = np.append(False, real[1:] & (ranks[1:] == ranks[:-1]))
        run = np.maximum.accumulate(np.where(same, 0, np.arange(len(ranks))))
        if longest > LONG_WORD:
            hit |= top & top[run]
        places = np.flatnonzero(hit & ((np.arange(len(ranks)) - run) % 2 == 0))
        single = alone[places]
        if single.any():
            # Of a word's places of such a rank the first one, or those with none near before them.
            opening = np.append(True, word[places][1:] != word[places][:-1]) & (ranks == least)[places]
            places = places[~single | opening | (top[places] if longest > LONG_WORD else False)]
        return places

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol makes; none for -1."""
        codes = symbols - self.size
        return np.where(symbols < 0, 0, np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4))))

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols[symbols >= 0]
        sizes = self._sizes(symbols)
        ids = np.repeat(symbols, sizes)
        strange = np.flatnonzero(symbols >= self.size)
        if len(strange):
            text = "".join(map(chr, (symbols[strange] - self.size).tolist())).encode("utf-8", "surrogatepass")
            ids[np.repeat(symbols >= self.size, sizes)] = self.bytes[np.frombuffer(text, np.uint8)]
        return ids.astype(np.int32)

    # -- decoding ----------------------------------------------------------------------------------

    @property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes one after the other, where each starts and how many it has."""
        if not hasattr(self, "_tables"):
            sizes = np.array([len(w) for w in self.written])
            self._tables = np.frombuffer(b"".join(self.written), np.uint8), np.cumsum(sizes) - sizes, sizes
        return self._tables

    def _written(self, ids: np.ndarray) -> str:
        flat, heads, sizes = self.tables
        parts = []
        for at in range(0, len(ids), BLOCK_CHARS):
            some = ids[at: at + BLOCK_CHARS]
            parts.append(flat[_runs(heads[some], sizes[some])].tobytes())
        return b"".join(parts).decode("utf-8", "each_byte")

    def decode(self, lists: list[np.ndarray | None]) -> list[str]:
        texts = []
        for ids in lists:
            if ids is None or not len(ids):
                texts.append("")
                continue
            silent = self.silent[ids]
            opening = ids[int(np.argmin(silent))]  # the first that is no control piece
            text = "".join(map(self._written, np.split(ids, np.flatnonzero(silent))))
            texts.append(text[1:] if self.spaced[opening] else text)
        return texts


@cache
def pieces(path: str) -> Pieces:
    """One per process and file, so that it outlives a task."""
    return Pieces(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of each row's whole text; `path` is a model on every executor."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pieces(path).encode(batch.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "ids"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of rows of doc_id and ids; null ids are an empty text."""
    python_ready(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            lists = [None if not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in ids]
            texts = pa.array(pieces(path).decode(lists), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, texts], names=["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
