"""Vectorised pre-token splitting for byte-level BPE files of the
``tokenizers`` library, and a bounded cache of the ids it gives.

``Splitter`` cuts whole batches of texts at the boundaries of the library's
byte-level pattern (contractions, runs of letters, numbers and other characters
with one leading space, white space).  The kind of a character is asked of the
library itself, once per distinct character, so its Unicode tables hold.
Special strings are cut out first, as the library does by default.  All ids
come from the library, for one pre-token at a time.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd

LETTER, NUMBER, OTHER, SPACE, CUT, UNKNOWN = range(6)
#: Lone surrogates cannot occur in valid text: one ends a document, the next ones stand for special strings.
DOC_END = 0xDC80


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the
    others for U+0100 and on, in byte order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 0x100 + k for k, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()


class Splitter:
    """Splits texts into pre-tokens; see ``split``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        self.tokenizer = Tokenizer.from_file(path)
        specials = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]) or len(specials) > 100:
            raise ValueError("special tokens that take their surroundings are not handled")
        self.special_ids = [i for _, i in specials]
        self._special = {s: chr(DOC_END + 1 + k) for k, (s, _) in enumerate(specials)}
        #: No pre-token looks like a special string, so it can stand for itself.
        self.special_of = {c: s for s, c in self._special.items()}
        longest_first = sorted(self._special, key=len, reverse=True)
        self._find_special = re.compile("|".join(map(re.escape, longest_first))) if specials else None
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self.kind[DOC_END:DOC_END + 0x80] = CUT
        self.rank = np.zeros(0x110000, np.uint32)  # small numbers of the characters seen, from 1
        self.n_ranks = 0

    def _learn(self, chars: np.ndarray) -> None:
        """Kinds of new characters: a character joins a run of its own kind."""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for c in chars.tolist():
            s = chr(c)
            if c in range(DOC_END, DOC_END + 0x80):
                kind = CUT
            elif len(pieces("a" + s)) == 1:
                kind = LETTER
            elif len(pieces("1" + s)) == 1:
                kind = NUMBER
            elif len(pieces("!" + s)) == 1:
                kind = OTHER
            else:
                kind = SPACE
            self.kind[c] = kind
            self.n_ranks += 1
            self.rank[c] = self.n_ranks

    def split(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """``joined``, the starts of all pieces in it (with its end behind
        them), the code of each piece (equal pieces, equal codes; from 0 in
        order of first appearance) and the first place of each code.  Every
        document is followed by one piece ``chr(DOC_END)``."""
        joined = "".join(t + "\udc80" for t in texts)
        if self._find_special and any(s in joined for s in self._special):
            joined = self._find_special.sub(lambda m: self._special[m[0]], joined)
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(cp):
            none = np.zeros(0, np.int64)
            return joined, np.zeros(1, np.int64), none, none
        rank = self.rank[cp]
        if not rank.all():
            self._learn(np.unique(cp[rank == 0]))
            rank = self.rank[cp]
        starts = self._starts(cp, self.kind[cp])
        bounds = np.append(starts, len(cp))
        codes, first = self._codes(rank, starts, np.diff(bounds))
        return joined, bounds, codes, first

    @staticmethod
    def _starts(cp: np.ndarray, kind: np.ndarray) -> np.ndarray:
        before = np.empty_like(kind)
        before[0], before[1:] = CUT, kind[:-1]
        after = np.empty_like(kind)
        after[-1], after[:-1] = CUT, kind[1:]
        start = kind != before
        start[1:] &= ~((cp[:-1] == 0x20) & (kind[1:] < SPACE))  # one U+0020 belongs to the run after it
        start |= (kind == SPACE) & (after < SPACE)  # the last white space before a run stands alone or leads the run
        start |= kind == CUT
        quote = np.flatnonzero((cp == 0x27) & start)
        if len(quote):
            one = np.append(cp, [0, 0])[quote + 1]
            two = np.append(cp, [0, 0, 0])[quote + 2]
            size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
            for a, b in ("re", "ve", "ll"):
                size[(one == ord(a)) & (two == ord(b))] = 3
            quote, size = quote[size > 0], size[size > 0]
            start[quote + 1] = False
            end = quote + size
            start[end[end < len(cp)]] = True
        return np.flatnonzero(start)

    def _codes(self, rank: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers equal pieces alike.  Pieces are packed into 64-bit words; a
        mixed word is grouped, and the packed words prove each group."""
        width, per = (np.uint8, 8) if self.n_ranks < 256 else (np.uint16, 4) if self.n_ranks < 65536 else (np.uint32, 2)
        small = np.zeros(len(rank) + per, width)
        small[:len(rank)] = rank
        words = np.ndarray((len(rank) + 1,), "<u8", small.data, strides=(small.itemsize,))
        bits = 64 // per
        keep = np.array([(1 << bits * k) - 1 for k in range(per + 1)], np.uint64)
        first_word = words[starts] & keep[np.minimum(sizes, per)]
        mixed = first_word * np.uint64(0x9E3779B97F4A7C15)
        layers = []
        at, k = np.flatnonzero(sizes > per), per
        while len(at):
            w = words[starts[at] + k] & keep[np.minimum(sizes[at] - k, per)]
            m = mixed[at]
            mixed[at] = (m ^ (m >> np.uint64(29)) ^ w) * np.uint64(0xBF58476D1CE4E5B9)
            layers.append((at, w))
            k += per
            at = at[sizes[at] > k]
        codes, _ = pd.factorize(mixed)
        codes = codes.astype(np.int64, copy=False)
        first = np.empty(int(codes.max()) + 1, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        rep = first[codes]
        same = (first_word == first_word[rep]).all() and (sizes == sizes[rep]).all()
        for at, w in layers:
            full = np.zeros(len(codes), np.uint64)
            full[at] = w
            same = same and (w == full[rep[at]]).all()
        if same:
            return codes, first
        keys = [small[s:s + n].tobytes() for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        codes = pd.factorize(np.array(keys, object))[0].astype(np.int64)
        first = np.empty(int(codes.max()) + 1, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        return codes, first

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that the library's BPE model gives each pre-token, end to
        end, and their numbers."""
        model = self.tokenizer.model
        ids: list[int] = []
        sizes = np.empty(len(pieces), np.int64)
        for k, p in enumerate(pieces):
            t = model.tokenize(p.encode().decode("latin-1").translate(BYTE_CHARS))
            sizes[k] = len(t)
            ids.extend([x.id for x in t])
        return np.array(ids, np.uint32), sizes


class Encoder:
    """Ids of whole texts.  The ids of pre-tokens are kept between calls, up to
    ``max_cached`` of them; then the cache starts afresh."""

    def __init__(self, path: str, max_cached: int = 800_000):
        self.splitter = Splitter(path)
        self.max_cached = max_cached
        self._clear()

    def _clear(self) -> None:
        self._slot: dict[str, int] = {}
        self._flat = np.zeros(1 << 16, np.uint32)
        self._from = np.zeros(1 << 14, np.int64)
        self._size = np.zeros(1 << 14, np.int64)
        self._used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self._slot)
        self._flat = self._room(self._flat, self._used + len(ids))
        self._flat[self._used:self._used + len(ids)] = ids
        self._from, self._size = self._room(self._from, n + len(pieces)), self._room(self._size, n + len(pieces))
        self._from[n:n + len(pieces)] = self._used + np.cumsum(sizes) - sizes
        self._size[n:n + len(pieces)] = sizes
        self._used += len(ids)
        self._slot.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, each text's followed by ``end_id``, and the
        place behind each text's last id."""
        s = self.splitter
        joined, bounds, codes, first = s.split(texts)
        if len(self._slot) > self.max_cached:
            self._clear()
        if not self._slot:
            self._add([chr(DOC_END), *s._special.values()], np.array([end_id, *s.special_ids], np.uint32), np.ones(1 + len(s.special_ids), np.int64))
        pieces = [joined[a:b] for a, b in zip(bounds[first].tolist(), bounds[first + 1].tolist(), strict=True)]
        new = [p for p in pieces if p not in self._slot]
        for i in range(0, len(new), 20_000):
            self._add(new[i:i + 20_000], *s.encode_pieces(new[i:i + 20_000]))
        slot = np.fromiter(map(self._slot.__getitem__, pieces), np.int64, len(pieces))
        size = self._size[slot][codes]
        ends = np.cumsum(size)
        shift = self._from[slot][codes] - (ends - size)
        ids = self._flat[np.repeat(shift, size) + np.arange(ends[-1] if len(ends) else 0)]
        is_end = (slot == self._slot[chr(DOC_END)])[codes]
        return ids, ends[is_end]


@lru_cache(maxsize=2)
def splitter_of(path: str) -> Splitter:
    """One splitter per Python worker and file."""
    return Splitter(path)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def slices(texts: list[str], max_chars: int = 1 << 22):
    """Index ranges of about ``max_chars`` characters; a longer text stands alone."""
    a, n = 0, 0
    for i, t in enumerate(texts):
        if n and n + len(t) > max_chars:
            yield a, i
            a, n = i, 0
        n += len(t)
    if a < len(texts):
        yield a, len(texts)
