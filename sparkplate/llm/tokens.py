"""Whole-text token ids of a ``tokenizers`` vocabulary, with a word cache, inside tasks.

The vocabulary's rules never look across white space (it is dropped and cuts words), so
the ids of a text are the ids of its words one after the other. Invented or natural, most
words of a task repeat; each distinct word is encoded by the library once and its ids are
kept as bytes, so a text is a join of byte strings.
"""

from __future__ import annotations

import hashlib
import os
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII controls that Python's ``split`` drops although the vocabulary does not.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")


def vocabulary(path: str) -> str:
    """The tokenizer file's content, read on the driver and shipped to the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others take the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class WordEncoder:
    """``ids(text)``: little-endian unsigned 32-bit ids of a whole text, as bytes.

    ``cache`` bounds the words kept; a full cache is emptied, which costs time only. A text
    that may hold the string of an added token goes to the library whole, as such a token is
    found inside and beside words.
    """

    @classmethod
    def of(cls, vocabulary: str) -> WordEncoder:
        """The worker's encoder of this vocabulary: Spark reuses Python workers, so later
        tasks find the words of earlier ones."""
        kept = sys.__dict__.setdefault("_sparkplate_encoders", {})
        name = hashlib.sha256(vocabulary.encode()).hexdigest()
        if name not in kept:
            kept.clear()
            kept[name] = cls(vocabulary)
        return kept[name]

    def __init__(self, vocabulary: str, cache: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = sorted({f(t[:2]) for t in added for f in (str.lower, str.upper, str)} | set(_ODD))
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.limit, self.known = cache, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _letters_only(self, word: str) -> bytes:
        """Ids of a lower-case word of letters below U+0100: no rule cuts or changes it, so
        the model takes it as it is."""
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _learn(self, new: set[str], plain: bool) -> None:
        """Words ending in one comma or stop are their letters plus that mark. ``plain``
        words are lower case and below U+0100."""
        known = self.known
        stems = {w[:-1] for w in new if w[-1] in ".," and w[:-1].isalpha()}
        rest = {w for w in new if not (w[-1] in ".," and w[:-1].isalpha())}
        ask = [w for w in stems | rest | {".", ","} if w not in known]
        if plain:
            for w in ask:
                if w.isalpha():
                    known[w] = self._letters_only(w)
            ask = [w for w in ask if w not in known]
        if ask:
            known.update(zip(ask, self._encode(ask)))
        for w in new:
            if w not in known:
                known[w] = known[w[:-1]] + known[w[-1]]

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in self.marks):
            return self._encode([text])[0]
        plain = True
        try:  # below U+0100 lower case maps letter by letter as in the vocabulary's rules
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            plain = False
        parts, known = text.split(), self.known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            self._learn({w for w in parts if w not in known}, plain)
            return b"".join(map(known.__getitem__, parts))


def texts(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """Rows (doc_id, text, *more) of Arrow batches, one at a time."""
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text", *more)))
