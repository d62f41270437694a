"""Token ids of whole texts by a given vocabulary file, one encoding per distinct piece.

The tokenizers of the ``tokenizers`` library first cut a text into pre-tokens and
encode each of them by itself. So the ids of a text are the ids of its pieces in
order, for any cut that falls only where the pre-tokenizer cuts as well. The cuts
here are of that kind, and a piece that has been encoded before is looked up: most
of a text is words seen earlier. The memory for pieces is bounded: it has two halves,
and when the younger is full the older is dropped, so frequent pieces stay. That
changes no id.

A text that holds the string of a special token goes to the library whole, as there the
string is cut out before anything else.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Unicode's white space, which the library's \s means.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Some letters, and ASCII punctuation without the apostrophe of contractions: a run
# of one kind ends where the other begins. A word with any other character is one
# piece, which the library cuts itself.
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
MARK = r"!-&(-/:-@\[-`{-~"


def _pieces(lead: str, rest: str) -> re.Pattern:
    """Words, each with ``lead`` before it; ``rest`` matches what else is kept."""
    return re.compile(
        f"{lead}[{LETTER}]+(?=[{MARK}{SPACE}]|\\Z)|{lead}[{MARK}]+(?=[{LETTER}{SPACE}]|\\Z)"
        f"|{lead}[^{SPACE}]+{rest}"
    )


# Byte-level vocabularies keep white space. A word takes one space before it along;
# the last character of a longer run stays out of the run when a word follows.
SPACED_PIECES = _pieces(" ?", f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Vocabularies with word ends drop white space and never reach across it.
WORD_PIECES = _pieces("", "")

# Bytes of each half of the remembered pieces, and about what one takes besides its
# characters and ids.
MEMORY = 40 * 1024 * 1024
PIECE_BYTES = 190
LONG_PIECE = 64


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    ``encode(None)`` and ``encode('')`` give no ids. No special token is added. Strings of
    special tokens in a text are their ids if ``special``, ordinary text otherwise.
    """

    def __init__(self, vocabulary: str, spaced: bool, special: bool = True, memory: int = MEMORY) -> None:
        from tokenizers import Tokenizer

        self.memory = memory

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.lower() for token in added] if special else []
        self.spaced = spaced
        self.pieces = SPACED_PIECES if spaced else WORD_PIECES
        self.known = _Known(self.tokenizer)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special:
            lowered = text.lower()
            if any(token in lowered for token in self.special):
                return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        known = self.known
        if known.held > self.memory:
            known.age()
        return b"".join(map(known.__getitem__, self.pieces.findall(text)))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and where each text's ids begin, and the last end.

        The bytes of all texts are cut by kind at once, Arrow numbers the strings between
        the cuts, and each different one is encoded once; the ids of all are then gathered
        by number.
        """
        apart = self._with_special(texts)
        if apart:
            plain = pa.array([i not in apart for i in range(len(texts))])
            texts = pc.if_else(plain, texts, pa.scalar("", texts.type))
        texts = pc.fill_null(texts, "").cast(pa.string())
        begins = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begins[0] : begins[-1]]
        cuts = _cuts(data, begins - begins[0], self.spaced)
        if self.known.held > self.memory:
            self.known.age()
        parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))
        numbered = parts.dictionary_encode()
        found = self._encode_parts(numbered.dictionary.to_pylist())
        size = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
        begin = np.cumsum(size) - size
        of = numbered.indices.to_numpy()
        each = size[of]
        ends = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(begin[of] - ends[:-1], each) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), dtype="<u4")[at]
        starts = ends[np.searchsorted(cuts, begins - begins[0])]
        return self._put_in(ids, starts, apart) if apart else (ids, starts)

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different strings between cuts.

        New ones of one kind are each one pre-token, so the library encodes them together,
        with a space between them; where the space is part of a piece, they bring it along.
        """
        known, findall = self.known, self.pieces.findall
        found = list(map(known.get, parts))
        new = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            part, found[k] = parts[k], known.older.get(parts[k])
            if found[k] is not None:
                known.remember(part, found[k])
            elif len(part) <= LONG_PIECE and ONE_KIND.fullmatch(part) and self.spaced == (part[0] == " "):
                new.append(k)
            else:
                found[k] = b"".join(map(known.__getitem__, findall(part)))
                known.remember(part, found[k])
        words = [parts[k] for k in new]
        joined = ("" if self.spaced else " ").join(words)
        encoding = self.tokenizer.encode(joined, add_special_tokens=False)
        of = np.array(encoding.word_ids, dtype=np.int64)
        ends = np.cumsum(np.bincount(of, minlength=len(words))) * 4
        ids = np.array(encoding.ids, dtype="<u4").tobytes()
        if len(ends) != len(words):
            raise ValueError("the vocabulary's pre-tokenizer cuts words of one kind")
        for k, a, b in zip(new, [0, *ends.tolist()], ends.tolist()):
            found[k] = ids[a:b]
            known.remember(parts[k], found[k])
        return found

    def _with_special(self, texts: pa.Array) -> dict[int, np.ndarray]:
        """Ids of the texts that hold a special token's string, by place."""
        if not self.special:
            return {}
        holds = [pc.fill_null(pc.match_substring(texts, token, ignore_case=True), False) for token in self.special]
        places = pc.indices_nonzero(functools.reduce(pc.or_, holds)).to_pylist()
        return {i: np.frombuffer(self.encode(texts[i].as_py()), dtype="<u4") for i in places}

    @staticmethod
    def _put_in(ids: np.ndarray, starts: np.ndarray, apart: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Insert the ids of texts that were encoded apart and are empty so far."""
        places = sorted(apart)
        joined = np.concatenate([apart[i] for i in places])
        whole = np.insert(ids, np.repeat(starts[places], [len(apart[i]) for i in places]), joined)
        grown = np.zeros(len(starts), dtype=np.int64)
        for i in places:
            grown[i + 1] += len(apart[i])
        return whole, starts + np.cumsum(grown)

    def count(self, text: str | None) -> int:
        return len(self.encode(text)) // 4


# The byte-level alphabet: a printable Latin-1 byte stands for itself, the others
# for the characters from U+0100 on, in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHER = [byte for byte in range(256) if byte not in _PLAIN]
ALPHABET = {byte: chr(0x100 + at) for at, byte in enumerate(_OTHER)}
ONE_KIND = re.compile(f" ?(?:[{LETTER}]+|[{MARK}]+)")


class _Known(dict):
    """Piece to its ids, filled on demand. Very long pieces are not remembered.

    A piece of one kind is one pre-token; others are cut by the library.
    """

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.held, self.older = 0, {}
        self.normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        # What the normalizer does to printable ASCII, where it is one of these.
        probe = "".join(map(chr, range(0x21, 0x7F)))
        ways = {probe: str, probe.lower(): str.lower}
        self.ascii_normal = ways.get(self.normal(probe), self.normal)
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize = tokenizer.model.tokenize

    def age(self) -> None:
        self.older = dict(self)
        self.clear()
        self.held = 0

    def remember(self, piece: str, ids: bytes) -> None:
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
            self.held += PIECE_BYTES + len(piece) + len(ids)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.ids_of(piece)
        self.remember(piece, ids)
        return ids

    def ids_of(self, piece: str) -> bytes:
        text = self.ascii_normal(piece) if piece.isascii() else self.normal(piece)
        if ONE_KIND.fullmatch(text):
            ids = [t.id for t in self.tokenize(text.encode().decode("latin-1").translate(ALPHABET))]
        else:
            ids = [t.id for part, _ in self.cut(text) for t in self.tokenize(part)]
        return _packed(ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# Kinds of bytes: white space, letters, marks, and all others. Letters of two bytes are
# found by their first, 0xC3; the two signs among them are none.
_SPACES, _LETTERS, _MARKS, _OTHERS, _PLAIN_OTHERS = 0, 1, 2, 4, 8
KIND = np.full(256, _OTHERS, dtype=np.uint8)
KIND[:128] = _PLAIN_OTHERS
KIND[[*range(0x09, 0x0E), 0x20]] = _SPACES
KIND[[ord(c) for c in map(chr, range(128)) if re.match(f"[{LETTER}]", c)]] = _LETTERS
KIND[[ord(c) for c in map(chr, range(128)) if re.match(f"[{MARK}]", c)]] = _MARKS
SIGNS = (0x97, 0xB7)


def _cuts(data: np.ndarray, begins: np.ndarray, spaced: bool) -> np.ndarray:
    """Places in UTF-8 ``data`` where white space begins, letters meet marks, or a text begins.

    Where white space is dropped they are also where it ends. Where it is kept, it begins
    only after bytes that are certain not to be white space themselves.
    """
    kind = KIND[data]
    first = np.flatnonzero(data[:-1] == 0xC3)
    first = first[~np.isin(data[first + 1], SIGNS)]
    kind[first] = kind[first + 1] = _LETTERS
    left, right = kind[:-1], kind[1:]
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        if spaced:
            blank = (right == _SPACES) & (left != _SPACES) & (left != _OTHERS)
        else:
            blank = (left == _SPACES) != (right == _SPACES)
        cut[1:-1] = blank | (left | right == _LETTERS | _MARKS)
    cut[begins] = True
    return np.flatnonzero(cut)


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str, spaced: bool, special: bool = True, memory: int = MEMORY) -> Encoder:
    """One encoder per worker process: later tasks find the pieces of earlier ones."""
    return Encoder(vocabulary, spaced, special, memory)
