"""Cutting texts at places that no pre-token of the byte-level pattern crosses.

The pattern's pre-tokens hold white space only at their start, and a single
space between two other characters always starts one. So a text can be cut
before each such space and its parts encoded one by one, with a memory of the
parts seen before; the ids are the same as those of the whole text.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space here includes the control characters 0x1C to 0x1F, which the pattern counts as symbols: fewer cuts, never more.
CUT = re.compile(r"(?<=\S)(?= \S)")
MEMORY = 300_000
AT_ONCE = 16_384  # new parts encoded together; bounds what the encoder needs beside its memory


def parts_of(text: str) -> list[str]:
    """The parts of a text; all but the first have lost the one space that they start with."""
    parts = CUT.split(text)
    return [parts[0]] + [p[1:] for p in parts[1:]]


def odd(part: str) -> bool:
    """Whether a piece between two spaces may not be a part: next to more white space a single space is no cut."""
    return not part or len(part.strip()) < len(part)


class PartMemory:
    """Ids of parts as bytes, for the parts of the last two generations of MEMORY parts each.

    What is forgotten is encoded again, so the size changes times, not results.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Iterable[bytes]],
        size: int = MEMORY,
        encode_plain: Callable[[list[str]], Iterable[bytes]] | None = None,
    ):
        """``encode_plain`` may encode parts that lost their space and have no other white space at their ends."""
        self.encode, self.size = encode, size
        self.encode_plain = encode_plain or (lambda parts: encode([" " + p for p in parts]))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, four bytes each."""
        ids, ends = self.flat_ids_of(pa.array(texts, pa.large_string()))
        raw, cuts = ids.tobytes(), (4 * ends).tolist()
        return [raw[start:end] for start, end in zip([0, *cuts], cuts)]

    def flat_ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, which are not null, in one array, and where each text's ids end in it.

        Texts are first cut at all spaces. Only pieces that are not known yet
        need a look: no odd one is ever remembered, so a text with one always
        shows, and is cut again with care. Each different part of the texts is
        looked up once; Python holds no object per occurrence.
        """
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        cut = pc.split_pattern(texts, " ")
        pieces = _Pieces(cut)
        with_care = pieces.texts_with(pieces.odd)
        with_care.update(i for i, p in enumerate(pieces.heads) if p and odd(p))
        if with_care:
            own = sorted(with_care)
            again = pa.array([parts_of(t) for t in texts.take(pa.array(own)).to_pylist()], cut.type)
            place = np.arange(len(cut))
            place[own] = len(cut) + np.arange(len(own))
            pieces = _Pieces(pa.concat_arrays([cut, again]).take(pa.array(place)))
        return pieces.gathered(self._ids_of_parts(pieces), self.encode(pieces.heads))

    def _ids_of_parts(self, pieces: _Pieces) -> list[bytes]:
        """Ids of the different parts that have lost their space; all but odd ones are remembered."""
        names, new, old = pieces.names, self.new, self.old
        ids = list(map(new.get, names))
        unknown = [i for i, known in enumerate(ids) if known is None]
        if pieces.odd.any():  # with white space at the end of a text
            at_end = np.flatnonzero(pieces.odd).tolist()
            for i, own in zip(at_end, self.encode([" " + names[i] for i in at_end])):
                ids[i] = own
            unknown = [i for i in unknown if ids[i] is None]
        parts = [names[i] for i in unknown]
        found = list(map(old.get, parts))
        missing = [p for p, own in zip(parts, found) if own is None]
        groups = [missing[k : k + AT_ONCE] for k in range(0, len(missing), AT_ONCE)]
        encoded = itertools.chain.from_iterable(map(self.encode_plain, groups))
        found = [next(encoded) if own is None else own for own in found]
        new.update(zip(parts, found))
        for i, own in zip(unknown, found):
            ids[i] = own
        return ids


class _Pieces:
    """The pieces of some texts: the first of each text, and the different ones among all others."""

    def __init__(self, cut: pa.Array):
        counts = cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(counts)
        self.first = self.ends - counts
        values = cut.flatten()
        self.heads = values.take(pa.array(self.first)).to_pylist()
        is_rest = np.ones(len(values), bool)
        is_rest[self.first] = False
        self.rest = np.flatnonzero(is_rest)
        coded = values.filter(pa.array(is_rest)).dictionary_encode()
        self.names: list[str] = coded.dictionary.to_pylist()
        self.odd = np.fromiter(map(ne, self.names, map(str.strip, self.names)), bool, len(self.names))
        self.odd |= pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
        self.index = coded.indices.to_numpy(zero_copy_only=False)

    def texts_with(self, marked: np.ndarray) -> set[int]:
        """Numbers of the texts with a marked piece."""
        if not marked.any():
            return set()
        return set(np.searchsorted(self.ends, self.rest[marked[self.index]], "right").tolist())

    def gathered(self, ids: list[bytes], heads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in their order, and the end of each text's, from those of the different pieces and of the first ones."""
        sizes = np.fromiter(map(len, itertools.chain(ids, heads)), np.int64, len(ids) + len(heads)) // 4
        start = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(itertools.chain(ids, heads)), "<u4")
        which = np.empty(len(self.rest) + len(heads), np.int64)
        which[self.rest] = self.index
        which[self.first] = len(ids) + np.arange(len(heads))
        size = sizes[which]
        reached = np.cumsum(size)
        source = np.repeat(start[which] - (reached - size), size)
        source += np.arange(len(source))
        return flat[source], reached[self.ends - 1] if len(reached) else np.zeros(0, np.int64)
