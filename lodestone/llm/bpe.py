"""Word-cached encoding with a public BPE vocabulary of the ``tokenizers`` library.

The vocabulary splits a normalised text into words and merges inside a word only, so the
ids of a text are those of its words.  Words repeat, texts hardly do: each worker keeps
a table of words it has met.  Texts with characters whose normalisation is not plain
lower-casing, and texts that may hold special-token strings (``<|``), go through the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import regex

#: Letters whose NFC form is themselves and whose lower case is one simple mapping.
_SPECIAL = re.compile(r"[^\x09-\x0D\x20-\x7E¡-įĲ-ɏ]")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words in a worker's table before it starts anew.  Workers outlive a stage and keep the
#: table, about 140 bytes a word and more while it grows, so twice as many do not fit an executor with other stages.
MAX_WORDS = 600_000
#: New words that are encoded in one call of the library.
AT_ONCE = 4096


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; the folder can be set by PUBLIC_TOKENIZERS_DIR."""
    folder = os.environ.get("PUBLIC_TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class CachedBPE:
    """Encode texts to little-endian uint16 ids (the vocabulary has fewer than 65,536)."""

    _shared: dict[str, "CachedBPE"] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.words: dict[str, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(False).items() if suffix and t.endswith(suffix)]] = True

    @classmethod
    def shared(cls, path: str) -> "CachedBPE":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def encode(self, text: str) -> bytes:
        if "<|" in text or _SPECIAL.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        chunks = text.lower().split()
        if new := set(chunks).difference(self.words):
            if len(self.words) + len(new) > MAX_WORDS:
                self.words.clear()
                new = set(chunks)
            self._learn(new)
        return b"".join(map(self.words.__getitem__, chunks))

    def _learn(self, new: set[str]) -> None:
        """Put new chunks (words with the marks around them) into the table, by their words."""
        have = self.words
        marked = {c: _WORDS.findall(c) for c in new if not c.isalpha()}
        words = {w for ws in marked.values() for w in ws}.difference(have)
        words.update(new.difference(marked))
        words = list(words)
        for a in range(0, len(words), AT_ONCE):
            have.update(zip(words[a : a + AT_ONCE], self._encode_words(words[a : a + AT_ONCE])))
        for c, ws in marked.items():
            if c not in have:
                have[c] = b"".join([have[w] for w in ws])

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, in one call: an id that ends a word is followed by the next word's first."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words) and cuts[-1] == len(ids):
            raw, cuts = ids.tobytes(), [0, *(2 * cuts).tolist()]
            return [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
