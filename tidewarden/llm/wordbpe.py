"""Token ids of whole texts by a ``tokenizers`` file, by way of its words.

The vocabularies meant here drop white space, so no token reaches across it and a text's
ids are its words' ids in a row. Words repeat, so each worker keeps the ids of those it
has met and asks the library only for new ones, many at a time.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

WORDS_KEPT = 350_000
"""Words whose ids a worker keeps; beyond that it starts anew."""
LONG = 1 << 20
"""Characters of a part of a long text."""
_STOPS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_IDS = np.dtype("<u4")


class WordTokenizer:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.ends = np.fromiter((t.endswith("</w>") for t in tokens), dtype=bool, count=size)
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        """The library's own ids of a text as it is."""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=_IDS).tobytes()

    def _long(self, text: str) -> bytes:
        """A very long text by parts that end before a space."""
        parts, at = [], 0
        while at < len(text):
            cut = text.find(" ", at + LONG)
            cut = len(text) if cut < 0 else cut
            parts += self.encode([text[at:cut]]) if cut - at <= 2 * LONG else [self.whole(text[at:cut])]
            at = cut
        return b"".join(parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        if any(len(t) > 2 * LONG and "<|" not in t for t in texts):
            return [self._long(t) if len(t) > 2 * LONG and "<|" not in t else self.encode([t])[0] for t in texts]
        split: list[list[bytes] | None] = []
        new: set[bytes] = set()
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        for text in texts:
            data = text.encode("utf-8", "surrogatepass")
            # A special token's name in a text is a token; lower-casing could make one.
            words = None if b"<|" in data else data.lower().split()
            split.append(words)
            if words:
                new.update(words)
        self._learn(new)
        known = self.known
        return [
            self.whole(t) if words is None else b"".join([known[w] for w in words])
            for t, words in zip(texts, split)
        ]

    def _learn(self, words: set[bytes]) -> None:
        known = self.known
        new = [w for w in words if w not in known]
        bases, later = set(), []
        for word in new:
            base = word.rstrip(_STOPS)
            # Between a letter or digit and a stop there is always a token boundary.
            if base and len(base) < len(word) and base[-1] in _ALNUM:
                stops = word[len(base) :]
                later.append((word, base, stops))
                bases.update(x for x in (base, stops) if x not in known)
            else:
                bases.add(word)
        plain = [w for w in bases if w.isalpha() or (not w.isascii() and w.decode("utf-8", "replace").isalpha())]
        odd = bases.difference(plain)
        for i in range(0, len(plain), 1000):
            some = plain[i : i + 1000]
            ids = np.frombuffer(self.whole(b" ".join(some).decode("utf-8")), dtype=_IDS)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                starts = [0, *cuts[:-1].tolist()]
                data = ids.tobytes()
                known.update((w, data[4 * a : 4 * b]) for w, a, b in zip(some, starts, cuts.tolist()))
            else:
                odd.update(some)
        for word in odd:
            known[word] = self.whole(word.decode("utf-8", "surrogatepass"))
        for word, base, stops in later:
            known[word] = known[base] + known[stops]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    return WordTokenizer(path)
