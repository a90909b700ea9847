"""Words of chunks as a tokenizer file makes them, and token ids through the ``tokenizers`` library.

Files of one kind are served: NFC, white space and lower-casing normalisers, a splitting
pattern that drops white space, byte-level letters and a BPE model.  Nothing in them joins
text across white space, so chunks between white space stand for themselves, and words
repeat: the library's model sees each distinct word once in a while.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from censa.llm.chunks import ChunkTable, Encode, Memory, flat

#: From here on what counts as a letter or digit depends on the Unicode version of a
#: library, so such chunks are split into words by the tokenizer library itself.
NEWER = "Ԁ"
#: Letters in either half of the memory of words.
WORD_LETTERS = 600_000
#: Stands after each chunk where chunks are cut to words together.
END = "\0"
SEPARATOR = f" {END} "


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Splitter:
    """Chunks to words in byte letters, and to ids where a chunk holds a special token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.spec = spec = json.load(file)
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or not splitter["invert"]:
            raise ValueError(f"{path} is another kind of tokenizer")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(splitter["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.letters = _byte_letters()

    def pieces(self, chunk: str) -> list[str | int]:
        if "<" in chunk and (parts := self.specials.split(chunk))[1:]:
            return [p for part in parts if part for p in ([self.special[part]] if part in self.special else self.pieces(part))]
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            words = self.words.findall(chunk.lower())
            return words if chunk.isprintable() else [self._letters(w) for w in words]
        if max(chunk) >= NEWER:
            normal = self.library.normalizer.normalize_str(chunk)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        normal = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if normal.isalpha():
            return [self._letters(normal)]
        return [self._letters(w) for w in self.words.findall(normal)]

    def folded(self, chunks: list[str]) -> list[str]:
        """The words of chunks below NEWER, without special tokens, with END after each chunk."""
        text = unicodedata.normalize("NFC", SEPARATOR.join([*chunks, ""])).replace("Σ", "σ").lower()
        written = self._letters("\n".join(self.words.findall(text)))
        return written.replace(self.letters[0], END).split(self.letters[ord("\n")])

    def _letters(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.letters)


class ChunkEncoder:
    """Ids of chunks by way of their words; ``encode_words`` gives the ids of words.

    Most chunks are cut to words all together, as one text with END between them.  Words are
    remembered for themselves, as they are met in many chunks.
    """

    def __init__(self, splitter: Splitter, encode_words: Encode) -> None:
        self.splitter, self.encode_words = splitter, encode_words
        self.words = Memory(self._encode, np.int32, WORD_LETTERS)

    def forget(self) -> None:
        self.words.clear()

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words; END has none, and END with a number after it is the id of that number."""
        marked = [k for k, w in enumerate(words) if w[0] == END]
        if not marked:
            return self.encode_words(words)
        plain = [w for w in words if w[0] != END]
        ids, sizes = self.encode_words(plain) if plain else flat([], np.int32)
        rows = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        return flat([([int(w[1:])] if w[1:] else []) if w[0] == END else next(rows) for w in words], np.int32)

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain, folded, rest = [], [], []
        for k, c in enumerate(chunks):
            if c.isascii() and c.isprintable() and "<" not in c:
                plain.append(k)
            elif "<" in c or END in c or max(c) >= NEWER:
                rest.append(k)
            else:
                folded.append(k)
        words = self.splitter.words.findall(SEPARATOR.join([chunks[k] for k in plain] + [""]).lower()) if plain else []
        if folded:
            words += self.splitter.folded([chunks[k] for k in folded])
        for k in rest:
            words += [p if isinstance(p, str) else f"{END}{p}" for p in self.splitter.pieces(chunks[k])]
            words.append(END)
        memory = self.words
        memory.renew()
        number = memory.young.numbers.__getitem__
        found = np.fromiter(map(number, words), np.int64, len(words))
        memory.learn()
        values, stops = memory.young.values(found)
        ends = stops[np.flatnonzero(found == memory.young.numbers[END])]  # of the chunks in the order plain, folded, rest
        order = np.array(plain + folded + rest)
        sizes = np.diff(ends, prepend=0)
        starts, out = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        starts[order], out[order] = ends - sizes, sizes
        moved = np.repeat(starts - np.cumsum(out) + out, out) + np.arange(len(values))
        return values[moved], out


@lru_cache(maxsize=2)
def encoder(path: str, limit: int = 1_250_000) -> ChunkTable:
    """Texts to ids, without special tokens added, truncation or padding; ``limit``: see :class:`Memory`."""
    splitter = Splitter(path)
    tokenize = splitter.library.model.tokenize
    return ChunkTable(ChunkEncoder(splitter, lambda words: flat([[t.id for t in tokenize(w)] for w in words], np.int32)), np.uint32, limit)
