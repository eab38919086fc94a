"""Token ids of whole texts by a given public tokenizer file, inside Arrow tasks."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stands between words when several are encoded at once. It must be one token; no word below holds it, see UNUSUAL.
SEPARATOR = "—"
STOPS = ".,"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Words seen before are kept with their ids, at most so many (about 150 bytes each).
MOST_WORDS = 300_000
#: Texts with these are encoded whole: white space on which libraries differ, letters outside Latin, special tokens.
UNUSUAL = "[\x1c-\x1fİɐ-\U0010ffff]|<\\|"

_encoders: dict[int, "WordEncoder"] = {}


def _gather(ids: np.ndarray, first: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids of the words at some places, one word after the other; a word has `count` ids from `first`."""
    count = count[at]
    total = np.cumsum(count)
    return ids[np.repeat(first[at] - total + count, count) + np.arange(total[-1] if len(total) else 0)]


def encoder(tokenizer_json: str) -> "WordEncoder":
    """This process's encoder for a tokenizer given as its file's content."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders[key] = WordEncoder(tokenizer_json)
    return _encoders[key]


class WordEncoder:
    """Ids of texts for tokenizers that lower-case, drop white space and never join across it.

    Words between white space are encoded once and looked up afterwards. A text in which that could
    differ from encoding it whole is encoded whole.
    """

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        mark = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the tokenizer has no single token for the separator")
        self.mark = mark[0]
        split, form = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        self.plain_letters = (  # whether a word of ASCII letters goes to the model as it is
            split is not None and split.pre_tokenize_str(LETTERS) == [(LETTERS, (0, len(LETTERS)))]
            and (form is None or form.normalize_str(LETTERS) == LETTERS))
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.first = np.zeros(1, np.int64)
        self.count = np.zeros(1, np.int64)
        self.seen = np.zeros(1, bool)  # again after it was stored
        self.ids = np.zeros(0, np.uint32)
        self.fill = 0

    def _encode(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in another order, their ids, one after the other, and their counts."""
        letters = [w for w in words if w.isascii() and w.isalpha()] if self.plain_letters else []
        model = self.tokenizer.model
        ids = [[token.id for token in model.tokenize(w)] for w in letters]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, count.sum())
        others = [w for w in words if not (w.isascii() and w.isalpha())] if self.plain_letters else words
        other_flat, other_count = self._encode_whole(others)
        return letters + others, np.concatenate([flat, other_flat]), np.concatenate([count, other_count])

    def _encode_whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of any kind, one after the other, and their counts."""
        between = f" {SEPARATOR} "
        joined = [between.join(words[i:i + 200]) + between for i in range(0, len(words), 200)]
        parts = [np.array(e.ids, np.uint32) for k in range(0, len(joined), 20)
                 for e in self.tokenizer.encode_batch_fast(joined[k:k + 20], add_special_tokens=False)]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.flatnonzero(flat == self.mark)
        count = np.diff(ends, prepend=-1) - 1
        return flat[flat != self.mark], count

    def _store(self, words: list[str], flat: np.ndarray, count: np.ndarray) -> None:
        known = len(self.place)
        while known + len(words) > len(self.first):
            self.first, self.count, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count, self.seen))
        while self.fill + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), 1 << 16), np.uint32)])
        self.first[known:known + len(words)] = self.fill + np.cumsum(count) - count
        self.count[known:known + len(words)] = count
        self.ids[self.fill:self.fill + len(flat)] = flat
        self.fill += len(flat)
        self.place.update(zip(words, range(known, known + len(words))))

    def _keep(self, words: list[str], flat: np.ndarray, count: np.ndarray) -> None:
        """Store new words. A full store first loses the words that no later slice had, at least half of all."""
        if len(self.place) + len(words) > MOST_WORDS:
            again = np.flatnonzero(self.seen[:len(self.place)])[:MOST_WORDS // 2]
            names = list(self.place)
            old = [names[i] for i in again], _gather(self.ids, self.first, self.count, again), self.count[again]
            self._clear()
            self._store(*old)
        room = MOST_WORDS - len(self.place)
        self._store(words[:room], flat[:count[:room].sum()], count[:room])

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, one after the other, and their counts: from the store, or encoded and stored."""
        at = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        known = at >= 0
        new, flat, fresh = self._encode([words[i] for i in np.flatnonzero(~known)])
        held = known.sum()
        ids = np.concatenate([_gather(self.ids, self.first, self.count, at[known]), flat])
        counts = np.concatenate([self.count[at[known]], fresh])
        # where a word stands among the known ones and then the new ones
        number = dict(zip(new, range(held, held + len(new))))
        order = np.empty(len(words), np.int64)
        order[known], order[~known] = np.arange(held), [number[words[i]] for i in np.flatnonzero(~known)]
        self.seen[at[known]] = True
        self._keep(new, flat, fresh)
        return _gather(ids, np.cumsum(counts) - counts, counts, order), counts[order]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        column = pa.array(texts, pa.large_string())
        usual = pc.invert(pc.match_substring_regex(column, UNUSUAL))
        plain = np.flatnonzero(usual.to_numpy(zero_copy_only=False)).tolist()
        for i in set(range(len(texts))).difference(plain):
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        if not plain:
            return out
        split = pc.utf8_split_whitespace(pc.utf8_lower(column.filter(usual)))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # a stop after a letter is a token of its own, so words are encoded without it
        stop = [w[-1] if len(w) > 1 and w[-1] in STOPS and w[-2].isalpha() else "" for w in distinct]
        number: dict[str, int] = {"": 0, ".": 1, ",": 2}  # no word at all has no ids
        parts = np.array([(number.setdefault(w[:-1] if s else w, len(number)), number[s]) for w, s in zip(distinct, stop)], np.int64).reshape(-1)
        flat, count = self._ids_of(list(number)[1:])
        count = np.r_[0, count]
        flat, count = _gather(flat, np.cumsum(count) - count, count, parts), count[parts].reshape(-1, 2).sum(axis=1)
        at = coded.indices.to_numpy()
        total = np.r_[0, np.cumsum(count[at])]
        flat = _gather(flat, np.cumsum(count) - count, count, at)
        ends = total[split.offsets.to_numpy()]
        for i, start, end in zip(plain, ends, ends[1:]):
            out[i] = flat[start:end]
        return out
