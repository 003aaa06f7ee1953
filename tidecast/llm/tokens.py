"""Token ids of whole texts by a vocabulary file of the tokenizers library.

Texts are cut into pieces at places that are boundaries of every pre-tokenizer
here.  The pieces of a block of texts are found and hashed with numpy; each
distinct piece is encoded by the library once and kept in a bounded cache of
the Python worker, and the texts' ids are gathered from the distinct pieces.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

#: Entries and bytes of a worker's piece cache; a full one becomes the old generation, from which pieces in use come back.
CACHE, CACHE_BYTES = 500_000, 16 << 20
#: Characters from which a text is encoded whole, so that the tables of a block stay small.
LONG = 1 << 22
#: White space beyond ASCII and control characters, on which vocabularies differ: such texts are encoded whole.
_ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
#: Letters whose runs many go through the library in one call.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE = _class(b" \t\n\r\x0b\x0c")
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)))
#: Punctuation that no vocabulary here joins to letters.
_PUNCT = _class(b".,!?;:|*#%&$")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20)
_T1, _T2 = (_RNG.integers(1, 2**63, 256, dtype=np.uint64) for _ in range(2))
_P1, _P2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


_POWERS = [np.ones(1, np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    """The first powers of both bases modulo 2^64, more than ``n`` of them; they are kept and grow as needed."""
    if len(_POWERS[0]) <= n:
        for k, p in enumerate((_P1, _P2)):
            x = np.full(1 << max(20, int(n).bit_length()), p, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x)
    return _POWERS


class _Cache:
    """A dictionary of two generations."""

    def __init__(self, size: int):
        self.size, self.new, self.old, self.held = size, {}, {}, 0

    def missing(self, keys: list) -> list:
        """Bring the known ones of ``keys`` (no key twice) into the new generation; the others."""
        if len(self.new) + len(keys) > self.size or self.held > CACHE_BYTES:
            self.old, self.new, self.held = self.new, {}, 0
        new, old, out = self.new, self.old, []
        fresh = [k for k in keys if k not in new]
        self.held += sum(map(len, fresh))
        for k in fresh:
            v = old.get(k)
            if v is None:
                out.append(k)
            else:
                new[k] = v
        return out


class Chunked:
    """Ids of texts, equal to encoding each text whole and adding no special tokens.

    A special token's name inside a text is text like any other; with ``named`` it is that token, as by the
    library's defaults, and texts that hold a name are encoded whole.
    """

    def __init__(self, path: str, keeps_space: bool, named: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not named
        # one sought after a normalizer counts as found in every text
        self.names = ["" if t.normalized else t.content
                      for t in self.tok.get_added_tokens_decoder().values()] if named else []
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # a vocabulary that drops white space folds case too
        self.keeps_space = keeps_space
        self.cache = _Cache(CACHE)
        if keeps_space:
            self.newline = self.tok.encode("a\na", add_special_tokens=False).ids[1]
        else:
            self.ends = np.zeros(self.tok.get_vocab_size(), bool)
            self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        words, other = [], []
        for p in self.cache.missing(pieces):
            (words if _WORD.fullmatch(p.decode()) else other).append(p)
        for lo in range(0, len(other), 4096):
            part = other[lo:lo + 4096]
            self.cache.new.update(zip(part, self._whole([p.decode() for p in part])))
        w = self.dtype.itemsize
        for lo in range(0, len(words), 2048):
            part = words[lo:lo + 2048]
            text = b"\n".join(part).decode()
            ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            if self.keeps_space:                              # a line end is one id, and no part of a word
                stop = np.append(np.flatnonzero(ids == self.newline), len(ids))
                start = np.append(0, stop[:-1] + 1)
            else:                                             # the last id of a word ends it
                stop = np.flatnonzero(self.ends[ids]) + 1
                start = np.append(0, stop[:-1])
            assert len(stop) == len(part), "a run of letters is one word"
            raw = ids.tobytes()
            self.cache.new.update((p, raw[a * w:b * w]) for p, a, b in zip(part, start.tolist(), stop.tolist()))

    def _cuts(self, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes as the vocabulary sees them, places where pieces begin)."""
        n = len(b)
        lead = b == 0xC3
        tail = np.zeros(n, bool)                              # second byte of a Latin-1 letter
        tail[1:] = lead[:-1] & (b[1:] != 0x97) & (b[1:] != 0xB7)
        if not self.keeps_space:
            b = _LOWER[b]
            b[tail & (b <= 0x9E)] += 32
        letter = _LETTER[b]
        ends = letter | tail                                  # a letter ends, begins here
        begins = letter.copy()
        begins[:-1] |= lead[:-1] & tail[1:]
        punct, space = _PUNCT[b], _SPACE[b]
        cut = np.zeros(n, bool)
        cut[1:] = (punct[1:] & ends[:-1]) | (punct[:-1] & begins[1:])
        if self.keeps_space:
            cut[1:] |= space[1:] & ~space[:-1]
            line = b == 10                                    # one line end, then a letter
            cut[2:] |= line[1:-1] & ~space[:-2] & begins[2:]
        else:
            cut[1:] |= space[1:] != space[:-1]
        cut[starts] = True
        at = np.flatnonzero(cut)
        return b, at

    def _block(self, raw: list[bytes]) -> list[bytes]:
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        start = np.cumsum(size) - size
        b, at = self._cuts(np.frombuffer(b"".join(raw), np.uint8), start[size > 0])
        end = np.append(at[1:], len(b))
        if not self.keeps_space:                              # white space gives no ids
            words = ~_SPACE[b[at]]
            at, end = at[words], end[words]
            if not len(at):
                return [b""] * len(raw)
        hashes = []
        for table, power in zip((_T1, _T2), _powers(len(b))):
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(table[b] * power[:len(b)], out=total[1:])
            hashes.append((total[end] - total[at]) * power[len(b) - at])      # all moved to one exponent
        order = np.argsort(hashes[0])
        fresh = np.empty(len(order), bool)
        fresh[0] = True
        np.not_equal(hashes[0][order[1:]], hashes[0][order[:-1]], out=fresh[1:])
        first = order[fresh]                                  # one place of each distinct piece
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        same = (hashes[1] == hashes[1][first][which]).all()
        if not same:                                          # two pieces under one hash: never seen, but told apart
            return self._whole([r.decode() for r in raw])
        text = b.tobytes()
        pieces = [text[x:y] for x, y in zip(at[first].tolist(), end[first].tolist())]
        self._learn(pieces)
        found = list(map(self.cache.new.__getitem__, pieces))
        w = self.dtype.itemsize
        count = np.fromiter(map(len, found), np.int64, len(found)) // w
        pool = np.frombuffer(b"".join(found), self.dtype)
        begin = (np.cumsum(count) - count)[which]
        count = count[which]
        after = np.cumsum(count)
        total = int(after[-1])
        ids = pool[np.arange(total) + np.repeat(begin - after + count, count)]
        ids = ids.tobytes()
        # where each text's ids end
        stop = np.append(0, after)[np.searchsorted(at, start + size)].tolist()
        return [ids[x * w:y * w] for x, y in zip([0, *stop], stop)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text (``dtype``)."""
        odd = [i for i, t in enumerate(texts) if len(t) > LONG or _ODD.search(t) or any(n in t for n in self.names)]
        out: list = [b""] * len(texts)
        for i in odd:
            out[i] = self._whole([texts[i]])[0]
        odd = set(odd)
        plain = [i for i, t in enumerate(texts) if t and i not in odd]
        if plain:
            for i, ids in zip(plain, self._block([texts[i].encode() for i in plain])):
                out[i] = ids
        return out


@functools.lru_cache(maxsize=2)
def chunked(path: str, keeps_space: bool, named: bool = False) -> Chunked:
    """One encoder for a Python worker."""
    return Chunked(path, keeps_space, named)
