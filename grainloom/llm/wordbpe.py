"""Token ids of whole texts by a word-end BPE of the `tokenizers` library.

The vocabulary's pre-tokenizer drops white space and never joins across it, so the ids of a text are those of its
pre-tokens in order. Pre-tokens of ASCII and Latin-1 text are found on the bytes of a whole slice at once; each worker
keeps the ids of those it has met, by a 64-bit hash, and only new ones reach the library. A white-space chunk that has
anything else (an apostrophe, a control character, a character from U+0100 on, "<|", with which the added tokens start)
is handed to the library as it stands, so that a written <|endoftext|> is that token, as in a plain call.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from grainloom.llm.textbytes import slices, spans, word_hashes

#: Pre-tokens a worker remembers before it starts anew.
REMEMBERED = 300_000
#: Bytes of text that are worked on at once.
AT_ONCE = 1 << 20

SPACE, LETTER, SIGN, DIGIT, HARD = range(5)
#: Classes of single bytes; those of two-byte characters from U+0080 to U+00FF follow in classes().
KIND = np.full(256, HARD, np.uint8)
KIND[0x21:0x7F] = SIGN
KIND[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
KIND[0x30:0x3A] = DIGIT
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[0x27] = HARD  # contractions start with it
LATIN = np.full(256, HARD, np.uint8)  # by the second byte after 0xC3
LATIN[0x80:0xC0] = LETTER
LATIN[[0x97, 0xB7]] = SIGN


def classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of every byte, and the bytes in lower case."""
    kind, low = KIND[data], data.copy()
    upper = (data >= 0x41) & (data <= 0x5A)
    low[upper] += 0x20
    lead = np.flatnonzero(data == 0xC3)
    if len(lead):
        second = data[lead + 1]
        kind[lead] = kind[lead + 1] = LATIN[second]
        low[lead[(second <= 0x9E) & (second != 0x97)] + 1] += 0x20
    kind[:-1][(data[:-1] == 0x3C) & (data[1:] == 0x7C)] = HARD  # an added token may start here
    return kind, low


def pre_tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units in data, which of them are hard, their hashes, and the units before each bound."""
    kind, low = classes(data)
    n = len(kind)
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    edge[bounds] = True
    solid = kind != SPACE
    # all of a chunk is one hard unit if any of it is hard
    change = edge.copy()
    change[1:n] |= solid[1:] != solid[:-1]
    at = np.flatnonzero(change)
    if (kind == HARD).any():
        is_hard = np.add.reduceat(kind == HARD, at[:-1], dtype=np.int64) > 0
        kind[spans(at[:-1][is_hard], np.diff(at)[is_hard])] = HARD
    cut = change
    cut[1:n] |= kind[1:] != kind[:-1]
    cut[1:n] |= kind[1:] == DIGIT
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    own = solid[starts]
    starts, ends = starts[own], ends[own]
    hard = kind[starts] == HARD
    where = np.flatnonzero(kind == HARD)
    low[where] = data[where]
    keys = word_hashes(low, starts, ends)
    keys[hard] ^= np.uint64(0xA5A5A5A5A5A5A5A5)
    return starts, ends, hard, keys, np.searchsorted(starts, bounds)


@cache
def byte_letters() -> list[str]:
    """The printable letter that byte-level pre-tokenizers write for each byte: itself where printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


class WordBpe:
    """Unit k of those remembered has the ids ids[first[k]:first[k] + count[k]]."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if any(not t.content.startswith("<|") or t.lstrip or t.rstrip or t.single_word or any(map(str.isspace, t.content)) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens must start with '<|' and stay within a white-space chunk")
        self.forget()

    def forget(self) -> None:
        self.code: dict[int, int] = {}
        self.first, self.count, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def _learn(self, units: list[tuple[int, bytes, bool]]) -> None:
        tokenize = self.tokenizer.model.tokenize
        easy = [(key, [t.id for t in tokenize(unit.decode() if unit.isascii() else "".join(map(byte_letters().__getitem__, unit)))]) for key, unit, hard in units if not hard]
        rest = [(key, unit.decode()) for key, unit, hard in units if hard]
        easy += ((key, e.ids) for (key, _), e in zip(rest, self.tokenizer.encode_batch_fast([u for _, u in rest], add_special_tokens=False) if rest else [], strict=True))
        counts = np.fromiter((len(ids) for _, ids in easy), np.int64, len(easy))
        flat = np.array([i for _, ids in easy for i in ids], np.uint32)
        have = len(self.code)
        while have + len(easy) > len(self.first):
            self.first, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.count))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.count[have : have + len(easy)] = counts
        self.first[have : have + len(easy)] = self.used + np.cumsum(counts) - counts
        self.used += len(flat)
        self.code.update((key, have + k) for k, (key, _) in enumerate(easy))

    def _codes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        import pandas as pd

        if len(self.code) > REMEMBERED:
            self.forget()
        place, own = pd.factorize(keys)
        listed = own.tolist()
        new = [k for k, key in enumerate(listed) if key not in self.code]
        if new:
            sample = np.empty(len(own), np.int64)
            sample[place] = np.arange(len(place))  # some place of each
            low = classes(data)[1]
            at = sample[new]
            self._learn([(listed[k], (data if h else low)[s:e].tobytes(), h) for k, s, e, h in zip(new, starts[at].tolist(), ends[at].tolist(), hard[at].tolist(), strict=True)])
        return np.fromiter(map(self.code.__getitem__, listed), np.int64, len(listed))[place]

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, last text, ids, bounds) for slices of a string column: text i's are ids[bounds[i - first]:bounds[i - first + 1]]."""
        for s in slices(column, most=AT_ONCE):
            if not len(s.data):
                yield s.first, s.last, np.zeros(0, np.uint32), np.zeros(s.last - s.first + 1, np.int64)
                continue
            starts, ends, hard, keys, units = pre_tokens(s.data, s.bounds)
            codes = self._codes(s.data, starts, ends, hard, keys)
            counts = self.count[codes]
            at = np.concatenate(([0], np.cumsum(counts)))
            yield s.first, s.last, self.ids[spans(self.first[codes], counts)], at[units]

    def counts(self, column: pa.Array) -> np.ndarray:
        out = [np.diff(bounds) for _, _, _, bounds in self.encode(column)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)


@cache
def loaded(path: str) -> WordBpe:
    """One a worker process."""
    from grainloom.llm.common import quiet_threads

    quiet_threads(keep_tokens=True)
    return WordBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
