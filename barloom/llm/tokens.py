"""Token ids of many texts at once, each different word encoded once."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from barloom.llm.words import flat, word_bounds, word_hashes

#: Words that one worker remembers; beyond it, it starts anew with the words at hand.
REMEMBERED = 1_500_000


#: Ids of some words in a row, and how many each word has.
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]

#: Words that are encoded as one text, with a mark between them.
JOINED = 200


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for x in ids for i in x), np.uint32, int(length.sum())), length


def word_bpe(path: str) -> Encode:
    """Ids by a `tokenizers` file whose words never span white space.

    Words go in as texts of JOINED words with a bar between them, which costs less than a result for
    each. Words that hold a bar, and all words where a bar isn't one id, are encoded one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    bar = tokenizer.encode("|", add_special_tokens=False).ids

    def single(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(bar) != 1:
            return single(words)
        texts = [" | ".join(words[i : i + JOINED]) + " |" for i in range(0, len(words), JOINED)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == bar[0])
        if len(ends) != len(words):  # another word has the bar's id
            return single(words)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        barred = np.fromiter(("|" in w for w in words), bool, len(words))
        if not barred.any():
            return run(words) if words else _flat([])
        plain_ids, plain = run([w for w, b in zip(words, barred) if not b]) if not barred.all() else _flat([])
        odd_ids, odd = single([w for w, b in zip(words, barred) if b])
        length = np.empty(len(words), np.int64)
        length[~barred], length[barred] = plain, odd
        ids = np.empty(int(length.sum()), np.uint32)
        of = np.repeat(barred, length)
        ids[~of], ids[of] = plain_ids, odd_ids
        return ids, length

    return encode


def piece_bpe(path: str) -> Encode:
    """Ids by a `sentencepiece` model, each word for itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return lambda words: _flat(model.encode(words, num_threads=1))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True


def parted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with the marks behind an ASCII letter at their end as words of their own."""
    cut = ends.copy()
    active = np.arange(len(ends))
    while len(active):
        active = active[(cut[active] - 1 > starts[active]) & _MARK[data[cut[active] - 1]]]
        cut[active] -= 1
    split = (cut < ends) & _LETTER[data[cut - 1]]
    n = 1 + split
    at = np.cumsum(n) - n
    first, last = np.repeat(starts, n), np.repeat(ends, n)
    last[at[split]] = cut[split]
    first[at[split] + 1] = cut[split]
    return first, last


class Encoder:
    """Encodes columns of texts word by word, words as parted by ASCII white space.

    `folds` says that the tokenizer lower-cases and never joins a letter with the marks behind
    it; then fewer different words remain. Texts that hold `<|` are taken as they are, as a
    special token may stand there.
    """

    def __init__(self, encode: Encode, folds: bool = False):
        self.encode, self.folds = encode, folds
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids, length = self.encode(words)
        start = len(self.pool) + np.cumsum(length) - length
        self.pool = np.concatenate([self.pool, ids])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.start, self.length = np.insert(self.start, at, start), np.insert(self.length, at, length)

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids before each text, word of each place, words before each text).

        Words are numbered within the call, in no particular order.
        """
        data, offsets = flat(column)
        starts, ends, before = word_bounds(data, offsets)
        if self.folds and len(starts) and b"<|" not in data.tobytes():
            data = _LOWER[data]
            starts, ends = parted(data, starts, ends)
            before = np.searchsorted(starts, offsets)
        hashes = word_hashes(data, starts, ends)
        unique, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != unique
        if new.any():
            raw = data.tobytes()
            self._learn(unique[new], [raw[starts[i] : ends[i]].decode() for i in first[new]])
            at = np.searchsorted(self.known, unique)
        begin, length = self.start[at][word], self.length[at][word]
        total = np.r_[0, np.cumsum(length)]
        ids = self.pool[np.arange(total[-1]) + np.repeat(begin - total[:-1], length)]
        return ids, total[before], word, before
