"""Token ids of the public byte-level BPE vocabulary, fast enough for whole corpora.

Its pre-tokenizer cuts a text into pieces that are encoded one by one. Words repeat, so the
pieces of a whole batch are cut in numpy and each distinct one is encoded once, by
``tiktoken`` with the vocabulary's own ranks, which merges a short piece faster. Texts that
are not plainly made of well-known characters, and those that spell out a special token, go
through the ``tokenizers`` library as they are. The ids are the library's either way.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

from .text import raw

#: The contractions that the pre-tokenizer splits off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

#: Code points that are cut in numpy; a text with any other goes through the library.
PLAIN = 0x2E80

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@functools.cache
def _kinds() -> np.ndarray:
    kinds = np.zeros(PLAIN, np.uint8)
    for point in range(PLAIN):
        category = unicodedata.category(chr(point))
        if category[0] == "L":
            kinds[point] = _LETTER
        elif category[0] == "N":
            kinds[point] = _NUMBER
        elif point in (0x20, 0x85) or 0x09 <= point <= 0x0D or category[0] == "Z":
            kinds[point] = _SPACE
        elif category == "Cn":
            kinds[point] = 255  # may be assigned in the library's tables
    return kinds


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _merger(path: str):
    import tiktoken

    # Byte-level vocabularies write each byte as a printable character: itself where it is
    # printable, else the next unused one from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=False)
    special = {token.content for token in tokenizer(path).get_added_tokens_decoder().values()}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in vocabulary.items()
        if token not in special
    }
    # Pieces come cut, so the pattern takes all it is given.
    return tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})


def _cut(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """True where a piece begins. ``firsts``: where the texts begin."""
    size = len(points)
    kinds = _kinds()[points]
    first = np.zeros(size + 1, bool)
    first[firsts] = True
    first[size] = True
    before = np.empty(size, np.uint8)
    before[0] = 255
    before[1:] = kinds[:-1]
    before[first[:size]] = 255
    begins = kinds != before
    space = kinds == _SPACE
    # A plain space goes with what follows it when that is no white space.
    followed = np.zeros(size, bool)
    followed[:-1] = (kinds[1:] != _SPACE) & ~first[1:size]
    lead = space & followed & (points == 0x20)
    begins[1:][lead[:-1]] = False
    begins |= lead
    # White space before a word keeps its last character apart: alone if it is no plain space.
    apart = space & followed & ~lead
    begins |= apart
    # Contractions: matched first wherever a piece may begin.
    quotes = np.flatnonzero((points == 0x27) & begins)
    for at in quotes:
        end = at + 1
        limit = min(size, at + 3)
        while end < limit and not first[end]:
            end += 1
        after = "".join(map(chr, points[at:end]))
        for short in CONTRACTIONS:
            if after.startswith(short):
                stop = at + len(short)
                begins[at + 1 : stop] = False
                if stop < size:
                    begins[stop] = True
                break
    return begins


class Encoder:
    """Encodes batches; keeps the ids of pieces seen, up to ``room`` of them."""

    def __init__(self, path: str, room: int = 500_000):
        self.tokenizer = tokenizer(path)
        self.merge = _merger(path).encode_ordinary
        self.special = [
            token.content for token in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.room = room
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Place of each distinct piece among the known ones, which new ones join."""
        get = self.known.get
        places = np.fromiter((get(piece, -1) for piece in pieces), np.int64, len(pieces))
        new = np.flatnonzero(places < 0)
        if len(new) and len(self.known) + len(new) > self.room:
            self._forget()
            new = np.arange(len(pieces))
        if len(new):
            found = [self.merge(pieces[i].decode()) for i in new]
            places[new] = np.arange(len(new)) + len(self.known)
            self.known.update(zip((pieces[i] for i in new), places[new].tolist()))
            self.ids = np.concatenate([self.ids, *map(np.array, found)]).astype(np.int64)
            self.sizes = np.concatenate([self.sizes, np.array([len(x) for x in found], np.int64)])
        return places

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and ``len(texts) + 1`` offsets into them; null is empty."""
        data, offsets = raw(texts)
        lengths = np.diff(offsets)
        plain = self._plain(data, offsets)
        ids: list[np.ndarray | None] = [None] * len(lengths)
        for row in np.flatnonzero(~plain):
            text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
            ids[row] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
        rows = np.flatnonzero(plain & (lengths > 0))
        if len(rows):
            keep = np.repeat(plain, lengths)
            flat, counts = self._pieces(data[keep], lengths[rows])
            for row, own in zip(rows, np.split(flat, np.cumsum(counts)[:-1])):
                ids[row] = own
        none = np.zeros(0, np.int64)
        parts = [none if own is None else own for own in ids]
        ends = np.cumsum([0, *(len(own) for own in parts)])
        return (np.concatenate(parts) if parts else none), ends

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts of known characters only, without a special token's text."""
        plain = np.ones(len(offsets) - 1, bool)
        # A lead byte of E2 BA or more is beyond PLAIN; so is every longer sequence.
        high = np.flatnonzero(data >= 0xE2)
        if len(high):
            after = data[np.minimum(high + 1, len(data) - 1)]
            beyond = high[(data[high] > 0xE2) | (after >= 0xBA)]
            plain[np.searchsorted(offsets, beyond, side="right") - 1] = False
        body = data.tobytes()
        for token in self.special:
            needle, at = token.encode(), -1
            while (at := body.find(needle, at + 1)) >= 0:
                plain[np.searchsorted(offsets, at, side="right") - 1] = False
        keep = np.repeat(plain, np.diff(offsets))
        try:
            text = data[keep].tobytes().decode("utf-8")
        except UnicodeDecodeError:
            return np.zeros(len(plain), bool)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        odd = np.flatnonzero(_kinds()[points] == 255)
        if len(odd):
            starts = (data & 0xC0) != 0x80
            at = np.flatnonzero(starts & keep)[odd]
            plain[np.searchsorted(offsets, at, side="right") - 1] = False
        return plain

    def _pieces(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of adjacent plain, non-empty texts, and how many each text has."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        text_at = np.cumsum(lengths) - lengths
        begins = _cut(points, np.searchsorted(chars, text_at))
        at = chars[begins]
        spans = np.append(at, len(data)).astype(np.int64)
        array = pa.Array.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(spans), pa.py_buffer(data)]
        ).dictionary_encode()
        places = self._places(array.dictionary.to_pylist())[array.indices.to_numpy()]
        starts = np.cumsum(self.sizes) - self.sizes
        count = self.sizes[places]
        ends = np.cumsum(count)
        place = np.arange(ends[-1]) - np.repeat(ends - count, count)
        ids = self.ids[np.repeat(starts[places], count) + place]
        owner = np.searchsorted(text_at, at, side="right") - 1
        return ids, np.bincount(owner, weights=count, minlength=len(lengths)).astype(np.int64)
