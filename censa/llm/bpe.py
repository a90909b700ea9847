"""BPE encoding by speculation and verification, and decoding.

Greedy longest match *proposes* the tokens of a word.  The proposal is the BPE result
exactly when each of its tokens is what BPE makes of the token's own text and every two
neighbours are *compatible*: merging their joint text would not cross their border.
Compatibility is checked for all distinct pairs of a batch at once in arrays.  Only the
words that fail are merged pair by pair.

Why a pair suffices: ranks grow from parts to whole, so the merges inside two neighbours
happen in the order of their ranks.  Undoing the later one again and again gives all
pieces that ever stood at the border together; the border is crossed when two such
pieces have a merge of their own that comes before the merge that used up either (at
equal ranks the one on the left comes first).

Null texts are empty: no ids, empty decoded text.  Repeated rows and equal texts give
equal rows; an empty table gives none.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.llm.arrays import Pool
from censa.llm.chunks import ChunkTable, flat
from censa.llm.shared import steps
from censa.llm.tokens import ChunkEncoder, Splitter

NEVER = np.iinfo(np.int64).max
#: Words of up to this many letters are taken side by side, longer ones one by one.
SHORT = 32
#: Byte letters are below this code point.
LETTERS = 512


class Bpe:
    """A tokenizer file with a BPE model, byte-level letters and an end-of-word suffix."""

    def __init__(self, path: str) -> None:
        self.splitter = Splitter(path)
        model, special = self.splitter.spec["model"], self.splitter.special
        vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        size = max(max(vocabulary.values()), *special.values()) + 1
        self.text = [""] * size
        for token, number in [*vocabulary.items(), *special.items()]:
            self.text[number] = token
        end = len(self.suffix)
        self.inner = {t: i for t, i in vocabulary.items() if not t.endswith(self.suffix)}
        self.last = {t[:-end]: i for t, i in vocabulary.items() if t.endswith(self.suffix)}
        #: The longest token that starts with two letters.
        self.reach: dict[str, int] = {}
        for token in self.inner | self.last:
            self.reach[token[:2]] = max(len(token), self.reach.get(token[:2], 1))
        self._plant()
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocabulary[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = vocabulary[self.text[a] + self.text[b]]
            self.merges[a, b] = rank, whole
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
        pairs = sorted(self.merges)
        self.pair_keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        self.pair_ranks = np.array([self.merges[p][0] for p in pairs], np.int64)
        self.whole = np.array([self.merges[p][1] for p in pairs], np.int64)
        made = np.flatnonzero(self.rank >= 0)
        if (self.rank[self.left[made]] >= self.rank[made]).any() or (self.rank[self.right[made]] >= self.rank[made]).any():
            raise ValueError(f"{path} has a token that is older than its parts")
        self.own: dict[int, bool] = {}

    def _plant(self) -> None:
        """A tree of the tokens' letters: sorted steps (node, letter) to the next node, and the token that ends at a node."""
        nodes: dict[tuple[int, int], int] = {}
        inner, last = [-1], [-1]
        for tokens, ends in ((self.inner, inner), (self.last, last)):
            for token, number in tokens.items():
                at = 0
                for letter in map(ord, token):
                    step = nodes.get((at, letter))
                    if step is None:
                        step = nodes[at, letter] = len(inner)
                        inner.append(-1)
                        last.append(-1)
                    at = step
                ends[at] = number
        keys = np.array([node * LETTERS + letter for node, letter in nodes], np.int64)
        order = np.argsort(keys)
        self.step_keys, self.step_to = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.ends = np.array([inner, last], np.int64)
        self.letter_ids = np.full((2, LETTERS), -1, np.int64)
        for row, tokens in enumerate((self.inner, self.last)):
            for token, number in tokens.items():
                if len(token) == 1:
                    self.letter_ids[row, ord(token)] = number

    def propose_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many words by greedy longest match, and how many each word has; all words take a letter at a time."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        stop = np.cumsum(sizes)
        who = np.flatnonzero(sizes)
        at, node = (stop - sizes)[who], np.zeros(len(who), np.int64)
        best, after = np.full(len(who), -1), at.copy()
        out_word, out_token = [], []
        while len(who):
            key = node * LETTERS + letters[at]
            place = np.minimum(np.searchsorted(self.step_keys, key), len(self.step_keys) - 1)
            goes = self.step_keys[place] == key
            node = self.step_to[place]
            at = at + goes
            ended = at == stop[who]
            token = self.ends[ended.astype(np.int64), node]
            better = goes & (token >= 0)
            best, after = np.where(better, token, best), np.where(better, at, after)
            done = ~goes | ended
            out_word.append(who[done])
            out_token.append(best[done])
            at, node, best = np.where(done, after, at), np.where(done, 0, node), np.where(done, -1, best)
            on = ~done | (after < stop[who])
            if not on.all():
                who, at, node, best, after = who[on], at[on], node[on], best[on], after[on]
        word, token = np.concatenate(out_word or [sizes[:0]]), np.concatenate(out_token or [sizes[:0]])
        return token[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """``merge`` of many words, side by side: each step merges the first pair of the lowest rank of every word."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > SHORT).tolist():
            out[k] = self.merge(words[k])
        low = 0
        for high in (8, 16, SHORT):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(group):
                continue
            letters = np.zeros((len(group), high + 1), np.int64)
            own = sizes[group]
            inside = np.arange(high + 1) < own[:, None]
            letters[inside] = np.frombuffer("".join(words[k] for k in group.tolist()).encode("utf-32-le"), np.uint32)
            tokens = np.where(inside, self.letter_ids[0][letters], -1)
            tokens[np.arange(len(group)), own - 1] = self.letter_ids[1][letters[np.arange(len(group)), own - 1]]
            ranks = self._ranks(tokens[:, :-1], tokens[:, 1:])
            columns, live = np.arange(high + 1), np.arange(len(group))
            while len(live):
                first = ranks[live].argmin(axis=1)
                on = ranks[live, first] < NEVER
                live, first = live[on], first[on]
                # The merged pair becomes one token, all after it move one place down.
                down = np.minimum(columns + (columns > first[:, None]), high)
                now = np.take_along_axis(tokens[live], down, axis=1)
                now[:, -1] = -1
                row = np.arange(len(live))
                now[row, first] = self.whole[self._pair(tokens[live, first], tokens[live, first + 1])]
                tokens[live] = now
                left = np.take_along_axis(ranks[live], down[:, :-1].clip(max=high - 1), axis=1)
                left[:, -1] = NEVER
                before = np.maximum(first - 1, 0)
                left[row, before] = self._ranks(now[row, before], now[row, before + 1])
                left[row, first.clip(max=high - 1)] = self._ranks(now[row, first], now[row, np.minimum(first + 1, high)])
                ranks[live] = left
            for k, line in zip(group.tolist(), tokens.tolist(), strict=True):
                out[k] = [t for t in line if t >= 0]
        return out

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs among the merges (the nearest place where there is no such merge)."""
        return np.minimum(np.searchsorted(self.pair_keys, a << 32 | b), len(self.pair_keys) - 1)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self._pair(a, b)
        return np.where((self.pair_keys[at] == (a << 32 | b)) & (a >= 0) & (b >= 0), self.pair_ranks[at], NEVER)

    def propose(self, word: str) -> list[int]:
        """Tokens by greedy longest match."""
        out, at, size = [], 0, len(word)
        while at < size:
            for stop in range(min(size, at + self.reach.get(word[at : at + 2], 1)), at, -1):
                token = (self.last if stop == size else self.inner).get(word[at:stop])
                if token is not None:
                    out.append(token)
                    at = stop
                    break
        return out

    def merge(self, word: str) -> list[int]:
        """Tokens by merging the pair of the lowest rank, leftmost first, until none is left."""
        tokens: list[int] = [self.inner[c] for c in word[:-1]] + [self.last[word[-1]]]
        after, before = [*range(1, len(tokens)), -1], [*range(-1, len(tokens) - 1)]
        queue = [(*self.merges[p], at) for at, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in self.merges]
        heapq.heapify(queue)
        while queue:
            _, whole, at = heapq.heappop(queue)
            right = after[at]
            if tokens[at] < 0 or right < 0 or self.merges.get((tokens[at], tokens[right]), (0, -1))[1] != whole:
                continue
            tokens[at], tokens[right] = whole, -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for first in (before[at], at):
                second = after[first] if first >= 0 else -1
                if second >= 0 and (found := self.merges.get((tokens[first], tokens[second]))):
                    heapq.heappush(queue, (*found, first))
        return [t for t in tokens if t >= 0]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the border of each pair of tokens survives the merging of their joint text."""
        fine = np.ones(len(a), bool)
        who = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        used_x, used_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(who):
            key = x << 32 | y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joined = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            crossed = (joined < used_x) & (joined <= used_y)
            fine[who[crossed]] = False
            made_x, made_y = self.rank[x], self.rank[y]
            on = ~crossed & ((made_x >= 0) | (made_y >= 0))
            who, x, y, used_x, used_y, made_x, made_y = (v[on] for v in (who, x, y, used_x, used_y, made_x, made_y))
            undo_x = made_x > made_y
            used_x, used_y = np.where(undo_x, made_x, used_x), np.where(undo_x, used_y, made_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return fine

    def _whole(self, token: int) -> bool:
        """Whether BPE makes this one token of the token's text."""
        if token not in self.own:
            text = self.text[token]
            if text.endswith(self.suffix):
                self.own[token] = self.merge(text[: -len(self.suffix)]) == [token]
            else:  # not at a word's end: the last letter is an inner one
                self.own[token] = self.rank[token] < 0 or bool(
                    self._whole(int(self.left[token])) and self._whole(int(self.right[token])) and self.compatible_below(token)
                )
        return self.own[token]

    def compatible_below(self, token: int) -> bool:
        """Whether the two parts of a token come to stand side by side before they are joined."""
        a, b = np.array([self.left[token]]), np.array([self.right[token]])
        x, y = int(a[0]), int(b[0])
        used_x = used_y = int(self.rank[token])
        while self.rank[x] >= 0 or self.rank[y] >= 0:
            if self.rank[x] > self.rank[y]:
                used_x, x = int(self.rank[x]), int(self.right[x])
            else:
                used_y, y = int(self.rank[y]), int(self.left[y])
            joined = self.merges.get((x, y), (NEVER, -1))[0]
            if joined < used_x and joined <= used_y:
                return False
        return True

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        ids, sizes = self.propose_all(words)
        owner = np.repeat(np.arange(len(words)), sizes)
        failing = np.zeros(len(words), bool)
        tokens, place = np.unique(ids, return_inverse=True)
        whole = np.fromiter((self._whole(int(t)) for t in tokens), bool, len(tokens))
        failing[owner[~whole[place]]] = True
        inner = owner[1:] == owner[:-1]
        pairs, place = np.unique((ids[:-1] << 32 | ids[1:])[inner], return_inverse=True)
        fine = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        failing[owner[1:][inner][~fine[place]]] = True
        again = np.flatnonzero(failing)
        if len(again):
            merged, lengths = flat(self.merge_all([words[k] for k in again.tolist()]), np.int64)
            fits = ~failing[owner]
            owner = np.concatenate([owner[fits], np.repeat(again, lengths)])
            ids = np.concatenate([ids[fits], merged])[np.argsort(owner, kind="stable")]
            sizes[again] = lengths
        return ids.astype(np.int32), sizes

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as a file without a decoder has it."""
        return " ".join(map(self.text.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str) -> tuple[Bpe, ChunkTable]:
    bpe = Bpe(path)
    return bpe, ChunkTable(ChunkEncoder(bpe.splitter, bpe.encode_words), np.int32)


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and the ids of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = coder(tokenizer)
        for batch, texts in steps(batches):
            ids, bounds = table.rows(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return _input(documents).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and the text of its ``ids`` (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = coder(tokenizer)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


@lru_cache(maxsize=2)
def _written(path: str) -> tuple[Pool, Pool]:
    """Each id in decimal, and each token's text, with a space after it."""
    bpe, _ = coder(path)
    return Pool([b"%d " % k for k in range(len(bpe.text))]), Pool([t.encode() + b" " for t in bpe.text])


def digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Per document the number of ids, and SHA-256 of the ids and of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = coder(tokenizer)
        for batch, texts in steps(batches):
            values, bounds = table.rows(texts)
            columns = []
            for pool in _written(tokenizer):
                joined, stops = pool.joined(values)
                raw, ends = memoryview(joined), stops[bounds].tolist()
                # Without the last space, as the words are joined by single ones.
                columns.append([hashlib.sha256(raw[lo : max(lo, hi - 1)]).hexdigest() for lo, hi in zip(ends[:-1], ends[1:], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), *map(pa.array, columns)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _input(documents).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _input(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
