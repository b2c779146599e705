"""Token ids of whole texts by a public word BPE, a batch of rows at a time.

White space never lies inside a token of a word BPE, so a text's ids are the
ids of its white-space-separated chunks in order. Chunks repeat a lot: Arrow
splits and dictionary-encodes a slice of texts, cuts the distinct chunks of
plain characters into words and dictionary-encodes these too, so that each
distinct word of a slice is looked up once, and the ids are gathered with numpy.
The caches of a Python worker are bounded: a full one becomes the old one, from
which what is still in use moves over, and the old one before it goes. That
changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Latin-1 letters, digits and ASCII punctuation but the apostrophe: for these
#: the tokenizer's pre-tokens are runs of letters, single digits and runs of
#: punctuation, and lower-casing and NFC work on each character alone.
_PLAIN = r"^[0-9A-Za-zÀ-ÖØ-öø-ÿ!-&(-/:-@\[-`{-~]+$"
_CUT = r"([0-9]|[!-&(-/:-@\[-`{-~]+)"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Cache:
    """Values by key, computed when missing; holds the last ``limit`` to twice as many keys."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit = compute, limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes:
        out = self.new.get(key)
        if out is None:
            out = self.old.get(key)
            if out is None:
                out = self.compute(key)
            if len(self.new) >= self.limit:
                self.old, self.new = self.new, {}
            self.new[key] = out
        return out


def _joined(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of ``parts`` (bytes), and where each part's begin and how many they are."""
    parts = list(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
    return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(size) - size, size


def _gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray, index: pa.Array, offsets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts ``index``, and where those of each list, given by ``offsets`` into ``index``, end."""
    index, offsets = index.to_numpy(zero_copy_only=False), offsets.to_numpy()
    n = size[index]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(start[index] - (ends - n), n) + np.arange(total)]
    return ids, np.concatenate([[0], ends])[offsets - offsets[0]]


class WordBpe:
    """Encodes Arrow string arrays; ids equal ``encode(text, add_special_tokens=False)``."""

    #: entries of about 200 bytes in one generation of a cache: of words, and of chunks of other characters
    WORDS, OTHERS = 100_000, 10_000
    #: bytes of text that are split at once
    SLICE = 3 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words, self.others = Cache(self._word, self.WORDS), Cache(self._other, self.OTHERS)

    def _word(self, word: str) -> bytes:
        level = word.encode("utf-8").decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(level)], "<u4").tobytes()

    def _other(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes() if chunk else b""

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary
        plain = pc.and_(pc.match_substring_regex(chunks, _PLAIN), pc.invert(pc.match_substring(chunks, "<|")))
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(chunks.filter(plain)), _CUT, r" \1 "))
        word = words.flatten().dictionary_encode()
        ids, cut = _gathered(*_joined(map(self.words.get, word.dictionary.to_pylist())), word.indices, words.offsets)
        other, start, size = _joined(map(self.others.get, chunks.filter(pc.invert(plain)).to_pylist()))
        # where each distinct chunk's ids are
        is_plain = plain.to_numpy(zero_copy_only=False)
        starts, sizes = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        starts[is_plain], sizes[is_plain] = cut[:-1], np.diff(cut)
        starts[~is_plain], sizes[~is_plain] = start + len(ids), size
        return _gathered(np.concatenate([ids, other]), starts, sizes, coded.indices, lists.offsets)

    def encode(self, texts: pa.Array):
        """Yield one ``uint32`` array per text; a null text counts as empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + self.SLICE, "right")))
            ids, cut = self._slice(texts.slice(at, to - at))
            for a, b in zip(cut[:-1], cut[1:]):
                yield ids[a:b]
            at = to


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The encoder of this Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
