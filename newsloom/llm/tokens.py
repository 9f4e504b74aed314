"""Token ids of whole texts by the `tokenizers` library.

Byte-level BPE first cuts a text by a pattern and then encodes each cut alone. A cut always
falls before a single blank between two characters that are not white space, so the parts of
such a split have the ids alone that they have in the whole text; and letters, sentence marks
and line ends are cut from each other. Parts and words repeat: their ids are remembered in
dictionaries of bounded size, and only new ones reach the library. A text that holds an added token's
content (`<|endoftext|>`), which the library finds before it cuts, goes to it whole."""

from __future__ import annotations

import re

import numpy as np

from newsloom.llm.common import kept, ship

ship(__name__)

REMEMBERED = 500_000  # entries of a dictionary before it starts anew
LONGEST = 64  # characters of a remembered part
MARKS = r"([!-&(-/:-@\[-`{-~]*)"  # ASCII marks but the apostrophe, which begins cuts of its own
LETTERS = r"([^\W\d_²³¹¼½¾]+)"
PLAIN_PART = re.compile(rf"{LETTERS}{MARKS}(?:\n{LETTERS}{MARKS})?")
LATIN_END = "ɐ"  # below it Python and the library agree on what a letter is


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes for themselves, the others for the characters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _NoCut(Exception):
    """A blank beside other white space: no cut there."""


class _Known(dict):
    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key: str) -> bytes:
        ids = self.learn(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = ids
        return ids


class _Parts(dict):
    """Ids of parts with the blank before them. A part of letters is one cut; one of letters and marks consists of such."""

    def __init__(self, encoder: "Encoder"):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, part: str) -> bytes:
        encoder = self.encoder
        if len(part) > LONGEST:
            return encoder.whole_part(part)
        if part.isascii() or max(part) < LATIN_END:
            if part.isalpha():
                ids = encoder.cut(" " + part)
            elif m := PLAIN_PART.fullmatch(part):
                word, marks, word2, marks2 = m.groups()
                ids = self[word] + encoder.whole[marks] if marks else self[word]
                if word2:
                    ids += encoder.whole["\n"] + encoder.words[word2] + (encoder.whole[marks2] if marks2 else b"")
            else:
                ids = encoder.whole_part(part)
        else:
            ids = encoder.whole_part(part)
        if len(self) >= REMEMBERED:
            self.clear()
        self[part] = ids
        return ids


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, with `end` appended."""

    def __init__(self, vocabulary: str, end: int | None = 0):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.tokenize = self.tokenizer.model.tokenize
        self.characters = byte_characters()
        self.blank = self.characters[32]
        self.packed = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.whole = _Known(self._library)
        self.words = _Known(self.cut)
        self.parts = _Parts(self)
        self.end = b"" if end is None else end.to_bytes(4, "little")

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def cut(self, word: str) -> bytes:
        """Ids of a cut of letters, with its leading blank if it has one."""
        seen = word.replace(" ", self.blank) if word.isascii() else "".join([self.characters[b] for b in word.encode()])
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(seen)])

    def whole_part(self, part: str) -> bytes:
        """Any other part, by the library."""
        if not part or part[0].isspace() or part[-1].isspace():
            raise _NoCut
        return self._library(" " + part)

    @staticmethod
    def _glued(raw: list[str]) -> list[str]:
        """The parts between blanks, with those put together again that no sure cut divides."""
        glued: list[list[str]] = [[raw[0]]]
        for p in raw[1:]:
            last = glued[-1][-1]
            if p and last and not p[0].isspace() and not last[-1].isspace():
                glued.append([p])
            else:
                glued[-1].append(p)
        return [" ".join(g) for g in glued]

    def _lead(self, part: str, alone: bool) -> bytes:
        if not alone and (not part or part[-1].isspace()):
            raise _NoCut
        return self.whole[part]

    def encode(self, text: str | None) -> bytes:
        """Null counts as empty: only the end id."""
        if not text:
            return self.end
        if self.added and self.added.search(text):
            return self._library(text) + self.end
        parts = text.split(" ")
        get = self.parts.__getitem__
        try:
            found = b"".join(map(get, parts[1:]))
            return self._lead(parts[0], len(parts) == 1) + found + self.end
        except _NoCut:
            head, *rest = self._glued(parts)
            found = [get(p) if not p[-1].isspace() else self._library(" " + p) for p in rest]
            return b"".join((self.whole[head], *found, self.end))


def seldom_collected(batches):
    """The batches, with Python's search for cyclic garbage only between them: it goes through the remembered ids again and
    again, and there are no cycles."""
    import gc

    gc.disable()
    try:
        for batch in batches:
            yield batch
            gc.collect(1)
    finally:
        gc.enable()


def worker_encoder(vocabulary: str, end: int | None = 0) -> Encoder:
    """The encoder of this worker process, which serves one task after another and so goes on
    remembering, until a step that encodes nothing lets it go: it may hold hundreds of megabytes."""
    return kept(("encoder", vocabulary, end), lambda: Encoder(vocabulary, end))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
