"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words."""

import re
import struct

from tokenizers import Tokenizer

#: Entries of each half of a cache, and the longest entry; they only save time.
CACHE, LONGEST = 120_000, 64

# Fixed values of the vocabulary file: its pattern of pieces, said for printable characters below U+0250, and the
# printable stand-ins of bytes.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_STAND_INS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(_PRINTABLE))
}


#: Ids as bytes, by their number.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(LONGEST)]


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < LONGEST else struct.pack(f"<{len(ids)}I", *ids)


class _Cache(dict):
    """What ``make`` says of a key. A full cache becomes the ``old`` one, from which what is asked for again comes back:
    frequent entries stay, however many rare ones pass by."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.old.clear()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    Pieces never cross white space, so texts are cut at blanks and line ends and each distinct word is encoded once
    while it stays in the cache. Words of printable characters below U+0250 (there, lower case and NFC are one
    character each) go to the model piece by piece; all others, and those that hold the mark of a special token,
    are encoded by the tokenizer as a whole.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.words = _Cache(self._word)
        self.pieces = _Cache(self._piece)

    def _piece(self, piece: str) -> bytes:
        # Printable ASCII stands for itself.
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_STAND_INS)
        return _packed([t.id for t in self.model.tokenize(shown)])

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pieces[word.lower()]
        plain = word.isprintable() and (word.isascii() or max(word) < "ɐ" and "İ" not in word)
        if not plain or "<|" in word:
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(word.lower())))

    def forget(self) -> None:
        """Give the caches back: an idle worker keeps its process."""
        self.words.forget()
        self.pieces.forget()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """The encoder of this process for a tokenizer file's text; its cache lives as long as the worker."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]
