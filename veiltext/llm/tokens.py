"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words per Python worker."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex

#: Words kept by a worker; beyond that the cache starts anew, which changes the time and not the ids.
CACHED_WORDS = 1_000_000
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Signs that end a word: a run of them is one piece.
_TAILS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class WordEncoder:
    """Ids of a tokenizer that drops white space, lower-cases and marks the ends of its pieces, so that words stand alone.

    Each different word is encoded once. Words of letters are one piece each: many new ones are encoded as one text
    that is split at blanks, and its ids are cut where pieces end. Signs at the end of such a word are a piece of their own.
    In other words the pieces are counted by the tokenizer's own split rule; where counts do not agree (special
    tokens, rare characters) the words are encoded one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.plain.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, dtype=bool)
        for token, at in self.tokenizer.get_vocab().items():
            self.ends[at] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}

    def _alone(self, words: list[bytes]) -> None:
        for word in words:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            self.known[word] = np.array(ids, dtype=self.dtype).tobytes()

    def _together(self, words: list[bytes], counts: list[int], tokenizer) -> None:
        for at in range(0, len(words), 512):
            some, count = words[at : at + 512], np.array(counts[at : at + 512])
            joined = b" ".join(some).decode()
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != count.sum() or (len(ids) and ends[-1] != len(ids)):
                self._alone(some)
                continue
            raw = ids.tobytes()
            last = (np.concatenate([[0], ends])[np.cumsum(count)] * self.dtype.itemsize).tolist()
            begin = 0
            for word, end in zip(some, last, strict=True):
                self.known[word] = raw[begin:end]
                begin = end

    def _learn(self, words: set[bytes]) -> None:
        letters, tails, tailed, odd, special = set(), set(), [], set(), []
        for word in words:
            stem = word.rstrip(_TAILS)
            if stem.isalpha():  # ASCII
                one = True
            else:
                one = unicodedata.normalize("NFC", stem.decode()).lower().isalpha()
            if b"<|" in word:
                special.append(word)
            elif one:
                if stem not in self.known:
                    letters.add(stem)
                if len(stem) < len(word):
                    tails.add(word[len(stem) :])
                    tailed.append((word, stem))
            else:
                odd.add(word)
        rest = list(odd | tails.difference(self.known))
        self._together(list(letters), [1] * len(letters), self.plain)
        self._together(rest, [len(_PIECES.findall(unicodedata.normalize("NFC", w.decode()).lower())) for w in rest], self.tokenizer)
        self._alone(special)
        for word, stem in tailed:
            self.known[word] = self.known[stem] + self.known[word[len(stem) :]]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        # special tokens are told by their case, all else is lower-cased by the tokenizer anyway
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=self.dtype) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
