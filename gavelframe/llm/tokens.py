"""Token ids of texts, by a public tokenizer, with each distinct word encoded once per worker."""

from __future__ import annotations

import os
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KNOWN_WORDS = 350_000
_WORDS_AT_ONCE = 200
_WORD_END = "</w>"
_STOPS = ".,;:!?()|%$&*#"  # not letters, digits or apostrophes: one piece behind a word


class WordEncoder:
    """Ids of whole texts, as the tokenizer gives them, from the ids of their words.

    Only for tokenizers that drop white space, never join across it, and mark
    the last token of a word: then the ids of a text are those of its words in
    turn. Words of letters, also with a stop behind, are encoded many at a time
    and told apart by the mark; if the marks do not add up, one by one. Memory
    is bounded: beyond `_KNOWN_WORDS`, new words are not kept.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._known: dict[str, int] = {}
        self._ids, self._sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.array([i for ids in found for i in ids], np.uint32), sizes

    def _encode_joined(self, words: list[str], pieces: int) -> tuple[np.ndarray, np.ndarray]:
        """For words that the tokenizer divides into `pieces` marked pieces each."""
        parts = [words[k : k + _WORDS_AT_ONCE] for k in range(0, len(words), _WORDS_AT_ONCE)]
        out = []
        encoded = self._tokenizer.encode_batch_fast([" ".join(part) for part in parts], add_special_tokens=False)
        for part, encoding in zip(parts, encoded, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self._last[ids]) + 1
            sound = len(ends) == pieces * len(part) and ends[-1] == len(ids)
            out.append((ids, np.diff(ends[pieces - 1 :: pieces], prepend=0)) if sound else self._encode_each(part))
        return np.concatenate([x for x, _ in out]), np.concatenate([n for _, n in out])

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their numbers, by kind of word, and the place of each word in `words`."""
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])
        for place, word in enumerate(words):
            kinds[0 if word.isalpha() else 1 if word.rstrip(_STOPS).isalpha() else 2].append(place)
        found = []
        for pieces, places in zip((1, 2, 0), kinds, strict=True):
            group = [words[place] for place in places]
            if group:
                found.append(self._encode_joined(group, pieces) if pieces else self._encode_each(group))
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        return ids, sizes, np.array([place for places in kinds for place in places], np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each text closed by `end_id`, and their numbers."""
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        distinct = coded.dictionary.to_pylist()
        code = np.fromiter(map(self._known.get, distinct, repeat(-1)), np.int64, len(distinct))
        ids, sizes = self._ids, self._sizes
        missing = np.flatnonzero(code < 0)
        if len(missing):
            new = [distinct[k] for k in missing.tolist()]
            new_ids, new_sizes, places = self._encode_new(new)
            code[missing[places]] = len(sizes) + np.arange(len(new))
            ids, sizes = np.concatenate([ids, new_ids]), np.concatenate([sizes, new_sizes])
            if len(self._known) + len(new) <= _KNOWN_WORDS:
                self._known.update(zip((new[k] for k in places.tolist()), range(len(self._sizes), len(sizes)), strict=True))
                self._ids, self._sizes = ids, sizes
        # The end is a word of one id, after the known ones.
        flat, sizes = np.append(ids, np.uint32(end_id)), np.append(sizes, 1)
        starts = np.cumsum(sizes) - sizes
        word = np.insert(code[coded.indices.to_numpy()], offsets[1:], len(sizes) - 1)
        n = sizes[word]
        place = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.arange(place[-1]) + np.repeat(starts[word] - place[:-1], n)]
        return out, np.diff(place[offsets + np.arange(len(offsets))])


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
