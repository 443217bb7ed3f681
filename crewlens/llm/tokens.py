"""Token ids of whole texts by a public tokenizer file, with a bounded memory of words seen.

The tokenizer lower-cases a text and cuts it into runs of letters, single digits and runs of other
signs, each of which it then encodes on its own. Here numpy finds these units, and each is encoded
once: a unit is known by a 64-bit hash afterwards. Words with an apostrophe, or with a letter whose
lower case is several characters, are units as a whole and are cut by the tokenizer itself.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache

import numpy as np

KNOWN_UNITS = 300_000
BLOCK_CHARS = 1 << 20
JOINED = 1000
SPACE, LETTER, NUMBER, SIGN, WHOLE = range(5)
# What the tokenizer takes for white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of every code point."""
    kinds = np.full(0x110000, SIGN, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        general = unicodedata.category(chr(code))[0]
        if general in "LN":
            kinds[code] = LETTER if general == "L" else NUMBER
        small = chr(code).lower()
        if len(small) == 1:
            lower[code] = ord(small)
        else:
            kinds[code] = WHOLE
    kinds[WHITE] = SPACE
    kinds[ord("'")] = WHOLE
    return kinds, lower


def _starts(flags: np.ndarray) -> np.ndarray:
    """Where values differ from the one before."""
    return np.flatnonzero(np.append(True, flags[1:] != flags[:-1]))


class Tokens:
    """encode(texts): the ids of each text, as unsigned 32-bit numbers."""

    def __init__(self, path: str, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True
        # Two generations: what is not met during a whole one is forgotten.
        self.known: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Texts are handled in blocks, long ones cut at white space, to bound the memory."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        block, owners, held = [], [], 0
        for owner, text in enumerate(texts):
            text = text or ""
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            at = 0
            while at < len(text):
                upto = min(len(text), at + BLOCK_CHARS)
                while upto < len(text) and text[upto] not in " \n\t":
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
        none = np.empty(0, np.uint32)
        return [none if not f else f[0] if len(f) == 1 else np.concatenate(f) for f in found]

    def _add(self, block: list[str], owners: list[int], found: list[list[np.ndarray]]) -> None:
        for owner, ids in zip(owners, self._block(block), strict=True):
            found[owner].append(ids)

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        kind_of, lower = _tables()
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, codes = kind_of[codes], lower[codes]
        if (kinds == WHOLE).any():  # such a character makes its whole word one unit
            words = _starts(kinds == SPACE)
            whole = np.maximum.reduceat(kinds, words) == WHOLE
            kinds = np.where(np.repeat(whole, np.diff(np.append(words, len(kinds)))), WHOLE, kinds)
        edge = np.append(True, kinds[1:] != kinds[:-1]) | (kinds == NUMBER)
        starts = np.flatnonzero(edge)
        lengths = np.diff(np.append(starts, len(codes)))
        place = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
        mixed = (codes + (place << np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.add.reduceat(mixed, starts)
        real = kinds[starts] != SPACE
        hashes, starts, lengths = hashes[real], starts[real], lengths[real]
        units, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        encoded = self._known(units.tolist(), codes, kinds, starts[first], lengths[first])
        # The ids of all units in order: each unit's run of ids, copied to where the unit stands.
        flat = np.frombuffer(b"".join(encoded), np.uint32)
        sizes = np.array([len(e) // 4 for e in encoded], np.int64)
        heads = np.cumsum(sizes) - sizes
        counts = sizes[place]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(heads[place] - (ends - counts), counts) + np.arange(counts.sum())]
        # Cut where the next text starts.
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        before = np.searchsorted(starts, text_ends)
        upto = np.append(0, ends)[before]
        return np.split(ids, upto[:-1])

    def _known(self, units: list[int], codes, kinds, starts, lengths) -> list[bytes]:
        if len(self.known) > KNOWN_UNITS:
            self.known, self.older = {}, self.known
        known, older, plain, whole = self.known, self.older, [], []
        missing = np.flatnonzero(~np.fromiter(map(known.__contains__, units), bool, len(units)))
        kinds = kinds[starts[missing]].tolist()
        for k, kind in zip(missing.tolist(), kinds, strict=True):
            if units[k] in older:
                known[units[k]] = older[units[k]]
            else:
                (whole if kind == WHOLE else plain).append(k)
        if plain or whole:
            text = codes.tobytes().decode("utf-32-le", "surrogatepass")
            starts, ends = starts.tolist(), (starts + lengths).tolist()
            for some in (plain[at: at + JOINED] for at in range(0, len(plain), JOINED)):
                encoded = self._joined([text[starts[k]: ends[k]] for k in some])
                known.update(zip((units[k] for k in some), encoded, strict=True))
            encoded = self._each([text[starts[k]: ends[k]] for k in whole])
            known.update(zip((units[k] for k in whole), encoded, strict=True))
        return list(map(known.__getitem__, units))

    def _each(self, units: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _joined(self, units: list[str]) -> list[bytes]:
        """Many units as one text: the last id of each is an end-of-word id."""
        ids = np.array(self.tokenizer.encode(" ".join(units), add_special_tokens=False).ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(units):  # a unit that the tokenizer cuts in another way
            return self._each(units)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]


@cache
def tokens(path: str) -> Tokens:
    """One per process and file, so that it outlives a task."""
    return Tokens(path)
