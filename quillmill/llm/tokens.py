"""Whole texts to token ids with the tokenizers library, each distinct word encoded once.

A text is cut at spaces where the tokenizer starts anew anyway, so the ids of its words
one after the other are the ids of the whole text. New words of many texts are encoded
in one call, with a separator between them that none of them holds.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: Words kept in a worker's memory, about 250 bytes each: those met of late and those before
#: them, so that frequent words are never encoded again. Results are the same.
STORED_WORDS = 500_000
#: Texts taken from an Arrow batch at a time.
ROWS = 1_500
#: Characters of the texts that are encoded together.
TOGETHER = 6_000_000
#: At most so many characters together for each word that is kept.
CHARACTERS_PER_WORD = 40
#: Words that a normalizer only lowers: one unit of letters, and perhaps one of punctuation.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]?")
MARKS = ".,;:!?"


def is_latin(text: str) -> bool:
    """Whether all characters are below U+0100, where lowering knows no context."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    ``drops_space`` names the two kinds of tokenizer: those that drop white space and
    put an end mark on words, and byte-level ones whose words carry the space before.
    """

    def __init__(self, path: str, drops_space: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = drops_space
        self.separator = " \x01 " if drops_space else "\n"
        self.mark = self._ids("\x01" if drops_space else "\n")[0]
        self.newline = np.array([self.mark], "<u4").tobytes()
        # merges alone, for words that are already lower and spelt in the model's byte letters
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {c: spell(c)[0][0] for c in map(chr, range(0x80, 0x100)) if PLAIN.fullmatch(c)}
        self.space = "" if drops_space else spell(" ")[0][0]
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)  # ends a word, or begins one
        for token, number in vocabulary.items():
            self.edge[number] = token.endswith("</w>") if drops_space else token.startswith(self.space)
        self.first: dict[str, bytes] = {}
        self.after: dict[str, bytes] = self.first if drops_space else {}
        self.older: dict[int, dict[str, bytes]] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _together(self, words: list[str], prefix: str, store: dict) -> None:
        """Encode words in one call, with the separator between them."""
        if not words:
            return
        ids = np.array(self._ids(self.separator.join([prefix + w for w in words])), "<u4")
        ends = [*(4 * np.flatnonzero(ids == self.mark)).tolist(), 4 * len(ids)]
        if len(ends) != len(words):
            raise AssertionError("a word holds the separator")
        data, start = ids.tobytes(), 0
        for word, end in zip(words, ends):
            store[word] = data[start:end]
            start = end + 4

    def _learn_plain(self, words: list[str], store: dict) -> None:
        """Merge plain words in one call; the model marks where each ends or begins."""
        if not words:
            return
        text = "\n".join(words) if self.drops_space else self.space + f"\n{self.space}".join(words)
        for mark in MARKS:
            text = text.replace(mark, f"\n{mark}")
        if self.drops_space:
            text = text.lower()
        for letter in sorted(set(text) & self.spelt.keys(), key="Ã".__ne__):  # all spellings begin with this one
            text = text.replace(letter, self.spelt[letter])
        ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        edges = np.flatnonzero(self.edge[ids])
        if self.drops_space:
            units = np.fromiter((2 if w[-1] in MARKS else 1 for w in words), np.int64, len(words))
            ends = np.append(edges, len(ids))[np.cumsum(units) - 1] + 1
        else:
            ends = np.append(edges[1:], len(ids))
        if len(ends) != len(words) or ends[-1] != len(ids):
            raise AssertionError("words and edges do not match")
        cuts, data = [0, *(4 * ends).tolist()], ids.tobytes()
        store.update(zip(words, map(data.__getitem__, map(slice, cuts, cuts[1:]))))

    def _forget(self, stored: int) -> None:
        """Once half of the room is taken, what was met before that goes."""
        if len(self.first) + (0 if self.drops_space else len(self.after)) > stored // 2:
            self.older = {id(store): store.copy() for store in (self.first, self.after)}
            self.first.clear()
            self.after.clear()

    def _learn(self, words: set[str], store: dict, prefix: str = "") -> None:
        older = self.older.get(id(store), {})
        again = words & older.keys()
        store.update(zip(again, map(older.__getitem__, again)))
        rest = words = list(words - again)
        if self.drops_space or prefix:
            self._learn_plain(list(filter(PLAIN.fullmatch, words)), store)
            rest = list(itertools.filterfalse(store.__contains__, words))
        together = []
        for word in rest:
            if "<|" in word or (word.find("\x01") >= 0 if self.drops_space else word.split() != [word]):
                store[word] = np.array(self._ids(prefix + word), "<u4").tobytes()
            else:
                together.append(word)
        self._together(together, prefix, store)

    def _split(self, text: str) -> list[tuple[str, list[str]]] | None:
        """First word and others of each line; None if the white space is anything but single ones."""
        if self.drops_space:
            return [("", (text.lower() if is_latin(text) else text).replace("\n", " ").split(" "))]
        flat = text.replace("\n", " ")  # printable text has no other white space than the space
        if "  " in flat or flat[:1] in ("", " ") or flat[-1] == " " or not flat.isprintable():
            return None
        return [(first, rest.split(" ") if rest else []) for first, _, rest in (line.partition(" ") for line in text.split("\n"))]

    def _segments(self, text: str) -> list[str]:
        return re.split(r"(?<=[!-~À-ɏ])(?= )", text)

    def encode(self, texts: list[str], stored: int = STORED_WORDS) -> list[bytes]:
        split = [self._split(t) for t in texts]
        self._forget(stored)
        other = {i: self._segments(t) for i, (t, lines) in enumerate(zip(texts, split)) if lines is None}
        lines = [line for found in split if found for line in found]
        if self.drops_space:
            self._learn(set().union(*(rest for _, rest in lines)) - self.first.keys(), self.first)
        else:
            self._learn({first for first, _ in lines}.union(*other.values()) - self.first.keys(), self.first)
            self._learn(set().union(*(rest for _, rest in lines)) - self.after.keys(), self.after, " ")
        first, after = self.first.__getitem__, self.after.__getitem__
        results = []
        for i, found in enumerate(split):
            if found is None:
                results.append(b"".join(map(first, other[i])))
            elif self.drops_space:
                results.append(b"".join(map(after, found[0][1])))
            else:
                results.append(self.newline.join([first(word) + b"".join(map(after, rest)) for word, rest in found]))
        return results


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encode_texts(path: str, drops_space: bool, texts: list[str | None], stored: int = STORED_WORDS):
    """Ids of each text in turn; a null text is empty. Encoders live as long as the worker.

    A worker that stores few words also takes fewer texts together, as their words are new ones.
    """
    encoder = _ENCODERS.get((path, drops_space)) or _ENCODERS.setdefault((path, drops_space), WordEncoder(path, drops_space))
    group, held, most = [], 0, min(TOGETHER, CHARACTERS_PER_WORD * stored)
    for text in texts:
        group.append(text or "")
        held += len(group[-1])
        if held > most:
            yield from encoder.encode(group, stored)
            group, held = [], 0
    yield from encoder.encode(group, stored)


def slices(batches):
    """Arrow batches in parts, so that little is held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
    pa.default_memory_pool().release_unused()
