"""Token ids of whole texts with a public tokenizer, at the speed of a dictionary.

The tokenizer never joins text across the start of a run of blanks, nor across the end of a run
of letters. A text is therefore put together from its words, and each word is given to the
tokenizer once per worker as long as its dictionary has room (the first words seen stay, which
are the frequent ones). Texts with runs of blanks or rarer kinds of blanks are cut by a pattern
of the same meaning, or go to the tokenizer whole.
"""

from __future__ import annotations

import re
import struct
import sys

import numpy as np

_PIECES = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_OTHER_BLANK = re.compile(r"[^\S \n\t\r]")
MOST_WORDS = 400_000  # about 80 MB a worker process; fewer words go to the tokenizer again with more
_ENDS = frozenset(",.;:!?")


class _Words(dict):
    """What the tokenizer makes of ``lead`` and a word."""

    def __init__(self, make, lead: str, most: int) -> None:
        self.make, self.lead, self.most = make, lead, most

    def __missing__(self, word: str):
        value = None
        if len(word) > 1 and word[-1] in _ENDS:
            before = word[-2]
            if before.isalpha() and before < "ɐ":  # a run of letters ends here
                value = self.make.both(self[word[:-1]], self.make.end(word[-1]))
        if value is None:
            value = self.make.of(self.lead + word)
        if len(self) < self.most:
            self[word] = value
        return value


class _Maker:
    """Values of pieces, and of two pieces that follow each other."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.ends: dict[str, object] = {}

    def end(self, char: str):
        if char not in self.ends:
            self.ends[char] = self.of(char)
        return self.ends[char]


class _Ids(_Maker):
    def of(self, piece: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids  # without offsets
        return struct.pack(f"<{len(ids)}I", *ids)

    def both(self, a: bytes, b: bytes) -> bytes:
        return a + b


class _Spans(_Maker):
    """First and end characters, tokens and characters of a piece."""

    def of(self, piece: str) -> tuple[bytes, bytes, int, int]:
        found = self.tokenizer.encode(piece, add_special_tokens=False)
        at = np.array(found.offsets, "<i8").reshape(-1, 2)
        return at[:, 0].tobytes(), at[:, 1].tobytes(), len(at), len(piece)

    def both(self, a: tuple, b: tuple) -> tuple[bytes, bytes, int, int]:
        first, end = (a[k] + (np.frombuffer(b[k], "<i8") + a[3]).tobytes() for k in (0, 1))
        return first, end, a[2] + b[2], a[3] + b[3]


def _is_plain(text: str, words: list[str]) -> bool:
    """Whether nothing but single blanks and line feeds stands between the words, and nothing around them."""
    if text[0] in " \n" or text[-1] in " \n" or any(two in text for two in ("  ", "\n\n", " \n", "\n ")):
        return False
    return len("".join(words)) + text.count(" ") + text.count("\n") == len(text)


class Encoder:
    """Ids and offsets of texts; a text with the string of a special token goes to the tokenizer whole, which knows it."""

    def __init__(self, path: str, most_words: int = MOST_WORDS) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.ids_of, self.spans_of = _Ids(tokenizer), _Spans(tokenizer)
        self.words = {kind: (_Words(kind, "", most_words), _Words(kind, " ", most_words)) for kind in (self.ids_of, self.spans_of)}

    def _parts(self, text: str, kind: _Maker) -> list:
        """Values of the text's pieces in order."""
        if not text:
            return []
        if any(token in text for token in self.special):
            return [kind.of(text)]
        bare, spaced = self.words[kind]
        words = text.split()
        if _is_plain(text, words):
            out, feed, at = [], kind.end("\n"), 0
            for line in text.split("\n"):
                end = at + line.count(" ") + 1
                out.append(bare[words[at]])
                out.extend(map(spaced.__getitem__, words[at + 1 : end]))
                out.append(feed)
                at = end
            out.pop()
            return out
        if _OTHER_BLANK.search(text):
            return [kind.of(text)]
        return [bare[piece] if piece[0] != " " or len(piece) < 2 else spaced[piece[1:]] for piece in _PIECES.findall(text)]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(self._parts(text, self.ids_of))

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of each token."""
        parts = self._parts(text, self.spans_of)
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first, end, tokens, chars = zip(*parts, strict=True)
        base = np.cumsum(np.array(chars))
        shift = np.repeat(base - chars, tokens)
        return np.frombuffer(b"".join(first), "<i8") + shift, np.frombuffer(b"".join(end), "<i8") + shift


def worker_encoder(path: str, most_words: int = MOST_WORDS) -> Encoder:
    """The encoder of this worker process; functions travel by value, so their globals end with a task."""
    known = sys.__dict__.setdefault("_docsettle_encoders", {})
    if (path, most_words) not in known:
        known[path, most_words] = Encoder(path, most_words)
    return known[path, most_words]
