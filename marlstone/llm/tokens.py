"""Byte-level BPE ids of many texts, with a vectorised front end.

Texts whose characters are all in Latin-1 and that have no apostrophe are
cut into pre-tokens with numpy (letters, digits, spaces and other characters,
as the vocabulary's own pattern cuts them), and each distinct pre-token is
encoded once per worker and kept in a bounded table.  Any other text goes to
the tokenizer as a whole.  The ids are those of the ``tokenizers`` library;
tests hold the two against each other.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Sequence

import numpy as np

from .common import mix64, powers

FAST_LIMIT = 0x100
TABLE_BITS = 22  # a worker's table has so many places, at most half of them taken
CHUNK_CHARS = 1 << 20

_SPACE = 0
_LETTER = 1
_NUMBER = 2
_OTHER = 3


def _classes() -> np.ndarray:
    out = np.full(FAST_LIMIT, _OTHER, np.uint8)
    for c in range(FAST_LIMIT):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = _LETTER
        elif kind[0] == "N":
            out[c] = _NUMBER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
    return out


_CLASS = _classes()
_LETTERS = mix64(np.arange(7, FAST_LIMIT + 7, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def pre_tokens(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all pre-tokens in the code points of several non-empty texts; every one ends where the next starts."""
    n = len(cp)
    kind = _CLASS[cp]
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start |= first[:n]
    # the last of a run of spaces before another character stands alone, or begins that character's token if it is U+0020
    space = kind == _SPACE
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    start |= last
    joined = np.flatnonzero(last & (cp == 32))
    start[joined + 1] = False
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts by one byte-level BPE vocabulary.

    ``path`` is a vocabulary for the ``tokenizers`` library.  ``ranks``, if
    given, is the same vocabulary for ``tiktoken``, which encodes new
    pre-tokens faster.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)  # open addressing by hash; 0: empty
        self.slot = np.zeros(1 << TABLE_BITS, np.int32)  # a pre-token's place below
        self.known = 0
        self.at = np.zeros(1, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.fast.encode_ordinary(text) if self.fast else self.plain(text), np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if self.known + len(keys) > (1 << TABLE_BITS) // 2:
            self._reset()
        new = [self.fast.encode_ordinary(w) for w in words] if self.fast else [x.ids for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, new), np.int64, len(new))
        used, more = int(self.at[-1]), int(lens.sum())
        if used + more > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.zeros(used + 2 * more, np.uint32)])
        self.ids[used : used + more] = np.fromiter((i for x in new for i in x), np.uint32, more)
        self.at = np.concatenate([self.at, used + np.cumsum(lens)])
        slots = np.arange(self.known, self.known + len(new), dtype=np.int32)
        self.known += len(new)
        mask = np.uint64(len(self.keys) - 1)
        i = keys & mask
        while len(keys):
            free = self.keys[i] == 0
            self.keys[i[free]] = keys[free]  # of several at one place, the last stays
            won = self.keys[i] == keys
            self.slot[i[won]] = slots[won]
            keys, slots, i = keys[~won], slots[~won], (i[~won] + np.uint64(1)) & mask

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b"".join(texts)
        cp = np.frombuffer(joined, np.uint8)
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        starts = pre_tokens(cp, offsets)
        ends = np.append(starts[1:], len(cp))
        p, inv = powers(len(cp) + 1)
        with np.errstate(over="ignore"):
            total = np.empty(len(cp) + 1, np.uint64)
            total[0] = 0
            np.cumsum(_LETTERS[cp] * p[: len(cp)], out=total[1:])
            h = mix64((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
        h |= np.uint64(1 << 63)  # never 0
        slot = self._find(h)
        while (miss := np.flatnonzero(slot < 0)).size:  # twice if the table was emptied to stay bounded
            keys, where = np.unique(h[miss], return_index=True)
            if len(keys) > (1 << TABLE_BITS) // 4:
                return [self.whole(t.decode("latin-1")) for t in texts]
            w = miss[where]
            self._learn(keys, [joined[a:b].decode("latin-1") for a, b in zip(starts[w].tolist(), ends[w].tolist())])
            slot = self._find(h)
        lens = self.at[slot + 1] - self.at[slot]
        until = np.cumsum(lens)
        places = np.repeat(self.at[slot] - (until - lens), lens) + np.arange(int(until[-1]) if len(until) else 0)
        ids = self.ids[places]
        cuts = np.searchsorted(starts, offsets)
        bounds = np.concatenate([[0], until])[cuts]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of the pre-tokens with these hashes, -1 for unknown ones."""
        mask = np.uint64(len(self.keys) - 1)
        i = h & mask
        key = self.keys[i]
        out = np.where(key == h, self.slot[i], -1)
        open_ = np.flatnonzero((key != h) & (key != 0))
        while len(open_):
            i[open_] = (i[open_] + np.uint64(1)) & mask
            key = self.keys[i[open_]]
            hit = key == h[open_]
            out[open_[hit]] = self.slot[i[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
        return out

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null or empty text has none."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        held, size = [], 0

        def flush() -> None:
            nonlocal held, size
            if held:
                for (i, _), ids in zip(held, self._chunk([raw for _, raw in held])):
                    out[i] = ids
            held, size = [], 0

        for i, t in enumerate(texts):
            if not t:
                continue
            try:
                raw = None if "'" in t else t.encode("latin-1")
            except UnicodeEncodeError:
                raw = None
            if raw is None:
                out[i] = self.whole(t)
                continue
            if size and size + len(raw) > CHUNK_CHARS:
                flush()
            held.append((i, raw))
            size += len(raw)
        flush()
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, ranks: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = (path, ranks, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def public_vocabulary() -> dict[str, str]:
    """Paths of the public 50k byte-level vocabulary, as ``encoder`` takes them."""
    import public_tokenizers as p

    return {"path": p.path("byte_bpe_50k.json"), "ranks": p.path("byte_bpe_50k.tiktoken"), "pattern": p.PATTERN}
