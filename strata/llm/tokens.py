"""Token ids of whole texts, with each distinct word encoded once a worker.

The word tokenizer splits at white space and never merges across it, so a text's ids are those of
its words in order. A worker keeps the ids of the words that it has met; only new words go to the
tokenizer. Splits are used where they hold for any text: at ASCII blanks (other white space stays
inside a word, which the tokenizer splits), and between a run of ASCII letters and ASCII punctuation
that ends a word. Texts are taken in groups, whose distinct words are looked up together.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strata.llm.common import BLANK_CLASS

#: Words that a worker remembers, some forty bytes each. Beyond it, it starts anew.
REMEMBERED = 2_000_000
VOCABULARY = "word_bpe_49k.json"

#: An odd factor that spreads hashes over the table's high bits (2^64 over the golden ratio).
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1

_ENDED = re.compile(r"([A-Za-z]+)([,.;:!?#$%&*]+)", re.ASCII)
#: Characters of a group of texts, and of a piece of a long one, about.
GROUP = 1 << 20


class WordIds:
    """Ids by word, in arrays: an open-addressed table from the word's 64-bit hash to a row of the
    table of ids. Words aren't kept, so a word costs some forty bytes, and two would have to agree
    in all 64 bits of the hash to be taken for each other."""

    def __init__(self, path: str) -> None:
        # One thread: Spark runs a worker on each core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.reset()

    def reset(self) -> None:
        self._count = 0
        self._bits = 17
        self._hashes, self._rows = self._empty()
        self._ids = np.empty(1 << 16, np.uint16)
        self._used = 0
        self._starts = np.zeros(1 << 16, np.int64)
        self._sizes = np.zeros(1 << 16, np.int32)

    def _empty(self) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(1 << self._bits, np.int64), np.full(1 << self._bits, -1, np.int32)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) * _MIX >> np.uint64(64 - self._bits)).view(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The rows of those hashes; -1 where there is none."""
        places = self._places(hashes)
        rows = self._rows[places].astype(np.int64)
        other = np.flatnonzero((rows >= 0) & (self._hashes[places] != hashes))
        while len(other):  # on to the next place, until it is empty or the word's
            places[other] = (places[other] + 1) & ((1 << self._bits) - 1)
            rows[other] = self._rows[places[other]]
            wrong = (rows[other] >= 0) & (self._hashes[places[other]] != hashes[other])
            other = other[wrong]
        return rows

    def _add(self, hashes: np.ndarray) -> np.ndarray:
        """The rows of new words of those hashes."""
        rows = np.arange(self._count, self._count + len(hashes))
        self._count += len(hashes)
        if 2 * self._count > 1 << self._bits:
            held = np.flatnonzero(self._rows >= 0)
            before = self._hashes[held], self._rows[held]
            self._bits = (2 * self._count - 1).bit_length()
            self._hashes, self._rows = self._empty()
            self._place(*before)
        self._place(hashes, rows)
        return rows

    def _place(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        places, mask = self._places(hashes), (1 << self._bits) - 1
        while len(rows):
            free = self._rows[places] < 0
            # Of several that want a free place, the last one written has it.
            self._rows[places[free]] = rows[free]
            settled = free & (self._rows[places] == rows)
            self._hashes[places[settled]] = hashes[settled]
            hashes, rows, places = hashes[~settled], rows[~settled], (places[~settled] + 1) & mask

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """ids holds the words' ids one after the other."""
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while self._count > len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._sizes = np.concatenate([self._sizes, np.zeros_like(self._sizes)])
        self._ids[self._used : self._used + len(ids)] = ids
        self._starts[numbers] = self._used + np.cumsum(sizes) - sizes
        self._sizes[numbers] = sizes
        self._used += len(ids)

    def _gather(self, rows: np.ndarray) -> np.ndarray:
        """The ids of those rows, one after the other."""
        sizes = self._sizes[rows].astype(np.int64)
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return np.empty(0, np.uint16)
        shift = np.repeat(self._starts[rows] - ends + sizes, sizes)
        return self._ids[shift + np.arange(ends[-1])]

    def _new(self, words: Iterable[str]) -> tuple[list[str], np.ndarray]:
        """Those of several different words that aren't known yet, and their rows from now on."""
        words = list(words)
        hashes = _hashes(words)
        unknown = np.flatnonzero(self._find(hashes) < 0)
        return [words[k] for k in unknown.tolist()], self._add(hashes[unknown])

    def _learn(self, words: list[str]) -> None:
        """Encode different words that aren't known yet."""
        letters: dict[str, None] = {}
        others: dict[str, None] = {}
        joined: dict[str, tuple[str, str]] = {}
        for word in words:
            if word.isascii() and word.isalpha():
                letters[word] = None
            elif ended := _ENDED.fullmatch(word):
                joined[word] = parts = ended[1], ended[2]
                letters[parts[0]] = others[parts[1]] = None
            else:
                others[word] = None
        new, rows = self._new(letters)
        # Nothing to normalise or split but case, so the model alone has the ids.
        tokenize = self._model.tokenize
        self._keep_lists(rows, [[token.id for token in tokenize(word.lower())] for word in new])
        new, rows = self._new(others)
        made = self._tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self._keep_lists(rows, [one.ids for one in made])
        new, rows = self._new(joined)
        if new:
            parts = [self._find(_hashes([joined[word][n] for word in new])) for n in range(2)]
            sizes = self._sizes[parts[0]] + self._sizes[parts[1]]
            self._keep(rows, self._gather(np.stack(parts, axis=1).ravel()), sizes.astype(np.int64))

    def _keep_lists(self, rows: np.ndarray, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint16, int(sizes.sum()))
        self._keep(rows, flat, sizes)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text is empty."""
        out: list[np.ndarray] = []
        group: list[str] = []
        held = 0
        for text in texts:
            text = text or ""
            if held + len(text) > GROUP:
                out += self._group(group)
                group, held = [], 0
            if len(text) > GROUP:
                # A very long text is taken in pieces, so that its words are never all in memory.
                parts = [self._group([piece])[0] for piece in _pieces(text)]
                out.append(np.concatenate(parts))
            else:
                group.append(text)
                held += len(text)
        return out + self._group(group)

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, of which no more than a group are held."""
        group: list[str | None] = []
        held = 0
        for text in texts:
            group.append(text.as_py())
            held += len(group[-1] or "")
            if held >= GROUP:
                yield from self.encode(group)
                group, held = [], 0
        yield from self.encode(group)

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if self._count > REMEMBERED:
            self.reset()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        words = split.flatten().dictionary_encode()
        known = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        hashes = _hashes(known)
        rows = self._find(hashes)
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            self._learn([known[k] for k in unknown.tolist()])
            rows[unknown] = self._find(hashes[unknown])
        each = rows[words.indices.to_numpy()]
        ends = np.append(0, np.cumsum(self._sizes[each], dtype=np.int64))
        return np.split(self._gather(each), ends[split.offsets.to_numpy()[1:-1]])


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words))


def _pieces(text: str, size: int = GROUP) -> list[str]:
    """The text cut at ASCII blanks into pieces of about that size; a word is never cut."""
    if len(text) <= size:
        return [text]
    cut = re.compile(rf"[{BLANK_CLASS}]")
    pieces, at = [], 0
    while at < len(text):
        found = cut.search(text, at + size)
        to = found.end() if found else len(text)
        pieces.append(text[at:to])
        at = to
    return pieces


@functools.lru_cache(1)
def word_ids(path: str) -> WordIds:
    """The worker's own table; it outlives a task."""
    return WordIds(path)
