"""Exact, cached encoding with the public tokenizers.

A text is cut at places where the tokenizer itself always cuts, each distinct
piece is encoded once by the library and remembered, and the ids of the text
are the concatenation of its pieces' ids. Texts for which the cut is not
provably the tokenizer's own go another way (see ``Encoder.pieces``), so the ids are
always those of encoding the whole text.
"""
from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: the tokenizer's byte-level split (fixed value, also public_tokenizers.PATTERN)
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# where the byte-level cut at spaces, newlines, commas and stops could differ
# from the pattern's: runs of white space or of symbols, a mark after a space
_PAIRS = ("  ", " \n", "\n ", "\n\n", " .", " ,", "\n.", "\n,", "_")
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SYMBOLS = re.compile(r"[^\w\s][^\w\s]")
# characters that str.split() drops but the tokenizer's \s does not
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_BARE = "\n.,"


def _odd(text: str) -> bool:
    return any(p in text for p in _PAIRS) or bool(_SYMBOLS.search(text) or _OTHER_SPACE.search(text))


def _odd_pairs() -> np.ndarray:
    """Which pairs of Latin-1 characters, as little-endian 16-bit numbers, make
    a text odd: what ``_odd`` looks for lies within two characters."""
    kinds = [*"a \n.,_\t#"]
    of = [kinds.index(c if c in kinds else "\t" if _OTHER_SPACE.match(c) else "#" if re.match(r"[^\w\s]", c) else "a")
          for c in map(chr, range(256))]
    odd = np.array([[_odd(a + b) for a in kinds] for b in kinds])  # the second is the high byte
    return odd[np.ix_(of, of)].ravel()


_ODD_PAIRS = _odd_pairs()


def is_odd(text: str) -> bool:
    """``_odd``; long Latin-1 texts, which most are, by one look at each pair."""
    if len(text) < 64:
        return _odd(text)
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return _odd(text)
    return bool(_ODD_PAIRS[np.frombuffer(raw, "<u2", len(raw) // 2)].any()
                or _ODD_PAIRS[np.frombuffer(raw, "<u2", (len(raw) - 1) // 2, 1)].any())


_LATIN = "\u0250"


def _byte_marks() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where it prints, else the next free one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {b: chr(b if b in prints else next(free)) for b in range(256)}


_BYTE_MARKS = _byte_marks()
#: pieces a cache holds in each of its two generations
CACHE = 300_000


def vocab_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def spaced(piece: str) -> str:
    """A piece of ``byte_pieces`` as it stood in the text."""
    return piece if piece[0] in _BARE else " " + piece


def byte_pieces(text: str, split) -> list:
    """(bare, pieces) parts of a text for the byte-level pattern. Without runs
    of white space or symbols, and without a mark after white space, a match
    starts at every space, newline, comma and stop: the text is cut there, and
    the pieces after the first are not bare (see ``spaced``). Other texts are
    cut by ``split``."""
    if not text:
        return []
    if not is_plain(text):
        return [(True, split(text))]
    parts = _marked(text).split(" ")
    return [(True, parts[:1]), (False, parts[1:])]


def is_plain(text: str) -> bool:
    return not (text[0] in " \n" or text[-1] in " \n" or is_odd(text))


def _marked(text: str) -> str:
    """A plain text with a space at each cut."""
    return text.replace("\n", " \n").replace(",", " ,").replace(".", " .")


#: characters of texts that are cut together
TOGETHER = 4 << 20


def together(texts: list, size: int = TOGETHER):
    """Runs (from, to) of texts of about ``size`` characters."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > size:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def numbered_pieces(texts: list, split) -> tuple[list, list, np.ndarray, np.ndarray]:
    """The distinct pieces of texts, bare and others, the number of the piece
    at each place (the bare ones are counted first), and how many places each
    text has: what ``byte_pieces`` gives, with one look-up for each distinct
    piece. ``split`` gives the bare pieces of a text that is to be cut by it,
    None for others, which are cut at spaces."""
    bare: dict[str, int] = {}
    plain, rests, firsts, own, counts = [], [], [], {}, np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if not t:
            continue
        parts = split(t)
        if parts is None:
            first, _, rest = _marked(t).partition(" ")
            plain.append(i)
            firsts.append(bare.setdefault(first, len(bare)))
            rests.append(rest or None)
        else:
            own[i] = [bare.setdefault(p, len(bare)) for p in parts]
            counts[i] = len(parts)
    cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
    words = pc.dictionary_encode(cut.flatten())
    n_rest = np.diff(cut.offsets.to_numpy())
    counts[plain] = n_rest + 1
    starts = np.cumsum(counts) - counts
    at = np.full(int(counts.sum()), -1, np.int64)
    at[starts[plain]] = firsts
    for i, numbers in own.items():
        at[starts[i]:starts[i] + len(numbers)] = numbers
    at[at < 0] = words.indices.to_numpy().astype(np.int64) + len(bare)
    return list(bare), words.dictionary.to_numpy(zero_copy_only=False).tolist(), at, counts


def gathered(values: list, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (bytes of 32-bit ids) in the order of ``at``, and how many ids
    come from each run of ``counts`` places."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    ids = np.frombuffer(b"".join(values), "<u4")
    n = sizes[at]
    ends = np.cumsum(n)
    of_text = np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])
    first = (np.cumsum(sizes) - sizes)[at]
    return ids[np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], of_text


class Pieces:
    """piece -> value in two generations: what is used moves to the young one;
    when that is full, it becomes the old one and the old one goes."""

    def __init__(self, encode_many, size: int | None = None):
        self.young: dict = {}
        self.old: dict = {}
        self.encode_many, self.size = encode_many, size or CACHE

    def get_all(self, pieces: list) -> list:
        young, old = self.young, self.old
        out = list(map(young.get, pieces))
        at = [i for i, v in enumerate(out) if v is None]
        if not at:
            return out
        new = {}
        for i in at:
            p = pieces[i]
            v = old.get(p)
            if v is None:
                new[p] = None
            else:
                out[i] = young[p] = v
        if new:
            new = list(new)
            young.update(zip(new, self.encode_many(new)))
            for i in at:
                if out[i] is None:
                    out[i] = young[pieces[i]]
        if len(young) > self.size:
            self.old, self.young = young, {}
        return out


class Encoder:
    """Ids of whole texts for a ``tokenizers`` file. ``value`` turns a list of
    ids into what is kept per piece (bytes of the ids, or their number)."""

    def __init__(self, path: str, value=None, byte_level: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.value = value or id_bytes
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.byte_level = byte_level
        self._word = self.tok.model.tokenize
        # bare: encoded as they are; spaced: a space goes before
        self.bare = Pieces(lambda ps: self._each(ps, ""))
        self.spaced = Pieces(lambda ps: self._each(ps, " "))
        self._split = None

    def _each(self, pieces: list, lead: str) -> list:
        """Values of pieces. Words of Latin letters are one pre-token, which
        the library's model takes as it is; the rest goes its whole way."""
        out, rest = [], []
        first, word_of = lead and _BYTE_MARKS[32], self._word
        for i, p in enumerate(pieces):
            if p.isascii() and p.isalpha() and self.byte_level:
                out.append(self.value([t.id for t in word_of(first + p)]))
            elif p.isalpha() and (p.isascii() or max(p) < _LATIN and "\u0130" not in p):
                word = p if self.byte_level else p.lower()
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(_BYTE_MARKS)
                out.append(self.value([t.id for t in self._word(first + word)]))
            else:
                out.append(None)
                rest.append(i)
        if rest:
            raw = [spaced(pieces[i]) if lead else pieces[i] for i in rest]
            for i, v in zip(rest, self._encode(raw)):
                out[i] = v
        return out

    def _encode(self, pieces) -> list:
        return [self.value(e.ids) for e in
                self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def pieces(self, text: str):
        """(cache, pieces) pairs whose values joined in order are the text's.

        Byte level: see ``byte_pieces``. Word level: white space is always a cut and is dropped;
        without runs of symbols, so are the places around a comma or stop.
        Texts that spell a special token are encoded whole.
        """
        if not text:
            return ()
        if any(s in text for s in self.specials):
            return ((None, [text]),)
        if not self.byte_level:
            if _ODD_SPACE.search(text):
                return ((None, [text]),)
            if "_" not in text and not _SYMBOLS.search(text):
                text = text.replace(",", " , ").replace(".", " . ")
            return ((self.bare, text.split()),)
        if self._split is None:
            import regex
            self._split = regex.compile(BYTE_PATTERN).findall
        return [(self.bare if bare else self.spaced, parts) for bare, parts in byte_pieces(text, self._split)]

    def batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts at byte level, one after the other, and how many each
        has: those of ``values`` joined. ``value`` must give bytes of ids."""
        if self._split is None:
            import regex
            self._split = regex.compile(BYTE_PATTERN).findall
        whole: set[str] = set()

        def split(text):
            if any(s in text for s in self.specials):
                whole.add(text)
                return [text]
            return None if is_plain(text) else self._split(text)

        bare, spaced_, at, counts = numbered_pieces(texts, split)
        # texts that spell a special token are not remembered
        values = self.bare.get_all([p for p in bare if p not in whole])
        if whole:
            rest = iter(values)
            values = [self._encode([p])[0] if p in whole else next(rest) for p in bare]
        return gathered(values + self.spaced.get_all(spaced_), at, counts)

    def values(self, text: str) -> list:
        out: list = []
        for cache, parts in self.pieces(text):
            out += self._encode(parts) if cache is None else cache.get_all(parts)
        return out


def id_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return array("I", ids).tobytes()


_ENCODERS: dict = {}


def encoder(path: str, value=None, byte_level: bool = True) -> Encoder:
    """One encoder per worker process and file, so its caches live across tasks."""
    key = (path, value, byte_level)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, value, byte_level)
    return _ENCODERS[key]
