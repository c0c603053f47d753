"""Token ids of texts by a given tokenizer, fast for texts with many repeated words.

A byte-level tokenizer cuts a text before every single space that a visible character follows, whatever stands around it,
so such pieces can be encoded by themselves. Each worker keeps the ids of pieces it has seen (at most ``KEPT_PIECES``) and
asks the tokenizer only for new ones. Texts that hold a special token's string are encoded whole.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np

KEPT_PIECES = 1_600_000
_ENCODERS: dict[str, Encoder] = {}
# A space that no visible character follows belongs to the piece before it.
_INNER = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")


class Encoder:
    """Encodes texts with one tokenizer file; one per worker process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        if not isinstance(self.tokenizer.pre_tokenizer, ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path}: not a byte-level tokenizer without normalisation")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level tokens have one character for each byte.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        self._forget()

    def _forget(self):
        self.places = {}
        self.used = 0
        self.flat = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 20, np.int64)
        self.sizes = np.zeros(1 << 20, np.int64)

    def _learn(self, pieces: list[str]):
        """Pieces that begin with a space and end visibly are encoded together, and told apart by the bytes of their ids."""
        joined, alone = [], []
        for p in pieces:
            (joined if p[:1] == " " and not p[-1].isspace() else alone).append(p)
        for at in range(0, len(joined), 4096):
            some = joined[at : at + 4096]
            whole = "".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.bytes_of[ids])
            own = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in some])
            last = np.searchsorted(ends, own)
            if len(ends) <= last[-1] or (ends[last] != own).any():
                alone += some
            else:
                self._keep(some, ids, np.diff(last + 1, prepend=0))
        for at in range(0, len(alone), 4096):
            some = alone[at : at + 4096]
            coded = [c.ids for c in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            self._keep(some, np.array([i for c in coded for i in c], np.uint32), np.array([len(c) for c in coded]))

    def _keep(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray):
        k, n = len(self.places), len(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while k + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
            self.sizes = np.concatenate([self.sizes, np.zeros(len(self.sizes), np.int64)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[k : k + n], self.sizes[k : k + n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(ids)
        self.places.update(zip(pieces, range(k, k + n), strict=True))

    def _pieces(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return [text]
        pieces = _CUT.split(text) if _INNER.search(text) else text.split(" ")
        first = pieces[0]
        pieces = (" " + "\x00 ".join(pieces)).split("\x00") if "\x00" not in text else [" " + p for p in pieces]
        pieces[0] = first
        return pieces

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if len(self.places) > KEPT_PIECES:
            self._forget()
        pieces, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                own = self._pieces(text)
                pieces += own
                counts[k] = len(own)
        at = np.fromiter(map(self.places.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            names = [pieces[i] for i in unknown.tolist()]
            self._learn(list(dict.fromkeys(names)))
            at[unknown] = np.fromiter(map(self.places.__getitem__, names), np.int64, len(names))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[at] - (ends - sizes), sizes)
        ids = self.flat[shift + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
