"""Token ids of many pieces of text, each distinct piece of a batch looked up or tokenized once.

The occurrences of a batch are coded by Arrow, and their ids gathered by numpy, so Python
touches distinct pieces only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

_BATCH_SIGNS = 2 << 20


def batched(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of about ``_BATCH_SIGNS`` characters, a longer text by itself."""
    low, held = 0, 0
    for high, text in enumerate(texts):
        if held and held + len(text) > _BATCH_SIGNS:
            yield texts[low:high]
            low, held = high, 0
        held += len(text)
    if low < len(texts):
        yield texts[low:]


def gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids at the given stretches, one stretch after the other."""
    at = np.repeat(starts - np.cumsum(counts) + counts, counts)
    at += np.arange(len(at))
    return ids[at]


class PieceTokens:
    """Ids of pieces; at most ``kept`` pieces that came in more than one batch are held for later ones."""

    def __init__(self, tokenize: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kept: int, fixed: dict[str, np.ndarray]):
        """``tokenize``: the ids of all given pieces in a row, and how many each has; ``fixed`` ones are never asked for."""
        self.tokenize, self.kept = tokenize, kept
        self.rows = {piece: i for i, piece in enumerate(fixed)}
        # The ids of row i stand from ends[i] up to ends[i + 1].
        self.ids = np.concatenate(list(fixed.values()))
        self.ends = np.r_[0, np.cumsum([len(ids) for ids in fixed.values()])].astype(np.int64)
        self.met = _Met()

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        coded = pieces.dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() is slow
        at = np.fromiter(map(self.rows.get, kinds, repeat(-1)), np.int64, len(kinds))
        lacking = np.flatnonzero(at < 0)
        new = [kinds[i] for i in lacking.tolist()]
        size, ids, ends = len(self.rows), self.ids, self.ends
        if new:
            new_ids, counts = self.tokenize(new)
            at[lacking] = np.arange(size, size + len(new))
            ids, ends = np.concatenate([ids, new_ids]), np.concatenate([ends, ends[-1] + np.cumsum(counts)])
            again = self.met.again(new, self.kept - size)
            kept = counts[again]
            self.rows.update(zip([new[i] for i in again.tolist()], range(size, size + len(again))))
            self.ids = np.concatenate([self.ids, gathered(ids, ends[size + again], kept)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(kept)])
        row = at[coded.indices.to_numpy()]
        counts = np.diff(ends)[row]
        return gathered(ids, ends[row], counts), counts


class _Met:
    """Which pieces were met before, by a bit of their hash.

    Most distinct pieces occur once, so a piece is kept from its second batch on.  A
    mistaken bit only keeps a piece early.
    """

    _BITS = 1 << 22

    def __init__(self):
        self.bits = np.zeros(self._BITS, bool)

    def again(self, pieces: list[str], room: int) -> np.ndarray:
        """Numbers of at most ``room`` of the pieces, all of which were met before."""
        at = np.fromiter(map(hash, pieces), np.int64, len(pieces)) & (self._BITS - 1)
        known = np.flatnonzero(self.bits[at])[: max(0, room)]
        self.bits[at] = True
        return known
