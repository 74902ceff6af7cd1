"""Token ids of texts with a public vocabulary file, word by word.

The vocabulary's pieces never span white space, so the ids of a text are those of its
words in order.  Words repeat far more often than texts: each Python worker keeps the
ids of up to ``MEMO_WORDS`` words (then starts over) and encodes only new ones.

The tokenizer lower-cases a word and parts letters from punctuation.  For the common
word, Latin letters with or without closing punctuation, these two steps are done here
and its model encodes the parts; every other word goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from struct import pack
from unicodedata import is_normalized

import numpy as np

VOCABULARY = "word_bpe_49k.json"
MEMO_WORDS = 500_000            # about 100 MB in a worker, the parts included
MEMO_CHARS = 40                 # longer words are encoded each time
CALL_WORDS = 2000               # new words encoded by one call
MARK = "\x01"
CLOSING = ".,!?;:"
LATIN_END = "\u0250"            # letters below are Latin in every Unicode version


def _visible_bytes() -> dict[int, str]:
    """The byte-level rule: printable Latin-1 bytes stand for themselves, the others for
    the characters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(256 + n) for n, b in enumerate(other)}


_VISIBLE = _visible_bytes()

# str.split also parts at four separators that the tokenizer reads as punctuation
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORDS = re.compile(r"[^ \t\n\r]+")


def _split(text: str | None) -> list[str]:
    if not text:
        return []
    return _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()


_ENCODERS: dict = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        mark = self._ids([MARK])[0]
        self.mark = int(mark[0]) if len(mark) == 1 else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4")
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, text: str) -> bytes:
        """Ids of lower-case letters or of punctuation, by the model alone."""
        found = self.parts.get(text)
        if found is None:
            visible = text if text.isascii() else text.encode().decode("latin-1").translate(_VISIBLE)
            ids = [t.id for t in self.tokenizer.model.tokenize(visible)]
            found = pack(f"<{len(ids)}I", *ids)
            if len(text) <= MEMO_CHARS:
                self.parts[text] = found
        return found

    def _plain(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters with or without closing punctuation; else None."""
        letters = word.rstrip(CLOSING)
        if letters and not (letters.isalpha() and (letters.isascii() or (max(letters) < LATIN_END
                                                                         and is_normalized("NFC", letters)))):
            return None
        lower = letters if letters.islower() else letters.lower()
        if not lower.isalpha() and lower:
            return None
        return (self._part(lower) if lower else b"") + (self._part(word[len(letters):]) if len(word) > len(letters) else b"")

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word.  Words that are not plain are encoded by the whole tokenizer,
        many to a call, parted by a mark with an id of its own; those that hold the mark
        are encoded alone."""
        if len(self.parts) > MEMO_WORDS // 2:
            self.parts.clear()
        out: dict[str, bytes] = {}
        rest = []
        for w in words:
            ids = self._plain(w)
            if ids is None:
                rest.append(w)
            else:
                out[w] = ids
        alone = [w for w in rest if MARK in w] if self.mark is not None else rest
        many = [w for w in rest if MARK not in w] if self.mark is not None else []
        for at in range(0, len(many), CALL_WORDS):
            part = many[at:at + CALL_WORDS]
            ids = self._ids([f" {MARK} ".join(part)])[0]
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(part) - 1:
                alone = alone + part
                continue
            raw = ids.tobytes()
            cuts = [-4, *(4 * ends).tolist(), len(raw)]
            out.update((w, raw[s + 4:e]) for w, s, e in zip(part, cuts, cuts[1:]))
        if alone:
            out.update((w, i.tobytes()) for w, i in zip(alone, self._ids(alone)))
        return out

    def __call__(self, texts) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none)."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        split = [_split(t) for t in texts]
        found = [list(map(memo.get, words)) for words in split]      # one look a word
        fresh = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
        if fresh:
            new = self._encode(list(fresh))
            memo.update((w, b) for w, b in new.items() if len(w) <= MEMO_CHARS)
            found = [[new[w] if i is None else i for w, i in zip(words, ids)] if None in ids else ids
                     for words, ids in zip(split, found)]
        return [b"".join(ids) for ids in found]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file (loaded once per process)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
