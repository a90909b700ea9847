"""Alignment of the tokens that two tokenizers make of the same text, by merge-path partitioning.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, read over a space and the
text, B a SentencePiece model, which adds the space itself.  Both cut the same bytes, so a text is a merge
of two ascending lists of token ends.

*Merge path*: step d of the merge has taken i ends of A and d - i of B, and i is found for any
d by a binary search on that diagonal alone.  Diagonals at equal distances therefore cut the merge of
a whole block of texts into independent pieces of equal work, however long a single text or token run is,
and all pieces are followed side by side.  Each piece emits the *overlaps* of an A with a B token and
marks the *links*, overlaps whose tokens end together.  The *groups* of a text lie between
links; a piece's first link closes the group that pieces before it left open, which stitches the pieces.

A corpus count of a link's id pair is taken from the distinct pairs of each part of some PART_BYTES of text,
and goes back to the parts by one join, so links themselves are never shuffled by pair.

A null or empty text, and one whose A or B tokens do not spell a space and the text, has no tokens: all
numbers 0, empty ``groups_sha256``.  Repeated rows are rows of their own, each counted.  Equal counts
tie as best.  An empty table gives no rows, other columns play no part.  The links of a very
long text are handed on in rows of at most LINKS links.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.llm.arrays import Pool, blocks
from censa.llm.chunks import ChunkTable, flat
from censa.llm.shared import kept
from censa.llm.tokens import _byte_letters

BLOCK_BYTES = 1 << 20
PART_BYTES = 8 << 20
LINKS = 1 << 18
LAST = np.iinfo(np.int64).max


#: A space with all up to the next space that follows something else than white space.  Neither tokenizer has a
#: token over such a border, so these chunks of a text are tokenised for themselves.
CHUNK = regex.compile(r" \p{White_Space}*(?:\P{White_Space}+(?:(?! )\p{White_Space}+\P{White_Space}*)*)?")
#: Ids of B are kept with those of A, from this number on; WRONG marks a chunk that is not spelled by both.
OTHER, WRONG = 1 << 24, -1


class Pair:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_file=path_b)
        byte = {letter: b for b, letter in _byte_letters().items()}
        names = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size())]
        special = {k for k, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.bytes_a = [n.encode() if k in special else bytes(byte[c] for c in n) for k, n in enumerate(names)]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        across = regex.compile(r"\P{White_Space} ")
        if any(across.search(t.decode(errors="replace")) for t in [*self.bytes_a, *self.bytes_b]):
            raise ValueError("a token holds a space after something else than white space")
        self.pool_a, self.pool_b = Pool(self.bytes_a), Pool(self.bytes_b)
        self.blank = [self.b.piece_to_id("▁")]
        ids = max(len(names), len(pieces))
        self.width = len(str(ids - 1))
        #: Decimal digits of each id, zero bytes after them, and a place for the sign that follows.
        self.digits = np.frombuffer(b"".join(str(k).encode().ljust(self.width + 1, b"\0") for k in range(ids)), np.uint8).reshape(ids, -1)
        self.n_digits = (self.digits != 0).sum(axis=1)
        self.table = ChunkTable(self._chunk_ids, np.int32, 750_000, CHUNK.findall)

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        # B adds the space itself, but not to nothing.
        b = [ids or self.blank for ids in self.b.encode([c[1:] for c in chunks], num_threads=1)]
        (ids_a, size_a), (ids_b, size_b) = flat(a, np.int32), flat(b, np.int32)
        wrong = self._misspelled(chunks, (a, ids_a, size_a), (b, ids_b, size_b))
        owner = np.concatenate([np.repeat(np.arange(len(chunks)), size_a), np.repeat(np.arange(len(chunks)), size_b)])
        ids = np.concatenate([ids_a, ids_b + OTHER])[np.argsort(owner, kind="stable")]
        sizes = size_a + size_b
        if len(wrong):
            rows = np.split(ids, np.cumsum(sizes)[:-1])
            for k in wrong.tolist():
                rows[k] = np.array([WRONG])
            return flat(rows, np.int32)
        return ids, sizes

    def _misspelled(self, chunks: list[str], *both: tuple[list[list[int]], np.ndarray, np.ndarray]) -> np.ndarray:
        """Chunks whose bytes are not those of the tokens of both tokenizers."""
        want = np.frombuffer("".join(chunks).encode(), np.uint8)
        stops = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        bad = np.zeros(len(chunks), bool)
        for (lists, ids, sizes), pool in zip(both, (self.pool_a, self.pool_b), strict=True):
            ends = np.cumsum(pool.sizes[ids])[np.cumsum(sizes) - 1]
            if (ends == stops).all():
                joined, _ = pool.joined(ids)
                bad[np.searchsorted(stops, np.flatnonzero(joined != want), "right")] = True
            else:  # rare, so one by one
                own = self.bytes_a if pool is self.pool_a else self.bytes_b
                bad |= [b"".join(map(own.__getitem__, x)) != c.encode() for x, c in zip(lists, chunks, strict=True)]
        return np.flatnonzero(bad)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B over all texts, and how many each text has; none for an empty text or one that either does not spell."""
        ids, bounds = self.table.rows([" " + t if t else "" for t in texts])
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        wrong = np.zeros(len(texts), bool)
        wrong[owner[ids == WRONG]] = True
        if wrong.any():
            fine = ~wrong[owner]
            ids, owner = ids[fine], owner[fine]
        of_b = ids >= OTHER
        return ids[~of_b].astype(np.int64), ids[of_b].astype(np.int64) - OTHER, *(np.bincount(owner[x], minlength=len(texts)) for x in (~of_b, of_b))


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d steps of the merge take from ``a`` (first at equal ends), for each diagonal d."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = np.zeros(len(low), bool)
        before[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low, high = np.where(before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return low


def links(a: np.ndarray, b: np.ndarray, work: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (in a, in b) of all overlaps and of all links of tokens by their ends, in order; ``work``: steps of a piece."""
    total = len(a) + len(b)
    work = work or max(16, int(np.sqrt(total)))
    diagonals = np.arange(0, total, work)
    i = merge_path(a, b, diagonals)
    j = diagonals - i
    # One end before the first and one after the last.
    ends_a, ends_b = np.concatenate([[0], a, [LAST]]), np.concatenate([[0], b, [LAST]])
    at_a, at_b = np.zeros((2, work, len(diagonals)), np.int64)
    overlap, link = np.zeros((2, work, len(diagonals)), bool)
    for t in range(min(work, total)):
        next_a, next_b, last_a, last_b = ends_a[i + 1], ends_b[j + 1], ends_a[i], ends_b[j]
        take_a = next_a <= next_b
        end = np.minimum(next_a, next_b)
        done = end == LAST
        overlap[t] = (end > np.maximum(last_a, last_b)) & ~done
        link[t] = ~take_a & (last_a == next_b) & ~done  # both ends are taken now, that of A before
        at_a[t], at_b[t] = i, j
        i, j = i + (take_a & ~done), j + (~take_a & ~done)
    # Piece after piece; a link's token of A is the one taken before.
    flat = lambda x, some: x.T[some.T]
    return flat(at_a, overlap), flat(at_b, overlap), flat(at_a, link) - 1, flat(at_b, link)


def group_strings(pair: Pair, a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The written groups of several texts one after the other, as bytes, and how many bytes come before each token of B and after the last.

    ``last_b``: places of the last token of B of each text.
    """
    n = len(a) + len(b)
    ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    start_b = np.concatenate([[0], link_b[:-1] + 1]) if len(link_b) else np.zeros(0, np.int64)
    own_a = np.repeat(start_b, np.diff(link_a, prepend=-1)) + np.arange(len(a))
    own_b = np.repeat(link_a + 1, np.diff(link_b, prepend=-1)) + np.arange(len(b))
    ids[own_a], ids[own_b] = a, b
    sign[own_a[link_a]], sign[own_b[link_b]] = ord("|"), ord(";")
    sign[own_b[last_b]] = 0
    written = pair.digits[ids]
    written[np.arange(n), pair.n_digits[ids]] = sign
    stops = np.concatenate([[0], np.cumsum(pair.n_digits[ids] + (sign != 0))])
    return written[written != 0], stops[own_b[last_b] + 1]


def aligned(pair: Pair, texts: list[str]) -> tuple[list[np.ndarray], dict[str, np.ndarray | list[str]]]:
    """For each text the id pairs (a << 32 | b) of its links, and its numbers."""
    ids_a, ids_b, n_a, n_b = pair.encode(texts)
    out = {"n_a": n_a, "n_b": n_b}
    over_a, _, link_a, link_b = links(np.cumsum(pair.pool_a.sizes[ids_a]), np.cumsum(pair.pool_b.sizes[ids_b]))
    stop_a = np.cumsum(n_a)
    bounds = np.concatenate([[0], np.searchsorted(link_a, stop_a)])
    found = ids_a[link_a] << 32 | ids_b[link_b]
    out["n_groups"] = out["n_links"] = np.diff(bounds)
    out["n_overlaps"] = np.diff(np.concatenate([[0], np.searchsorted(over_a, stop_a)]))
    fits = np.flatnonzero(n_b)
    written, stops = group_strings(pair, ids_a, ids_b, link_a, link_b, np.cumsum(n_b)[fits] - 1)
    raw, shown, low = memoryview(written), [""] * len(texts), 0
    for k, high in zip(fits.tolist(), stops.tolist(), strict=True):
        shown[k] = hashlib.sha256(raw[low:high]).hexdigest()
        low = high
    out["groups_sha256"] = shown
    return [found[lo:hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], out


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
ROW = "part long, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, links array<int>, pairs array<long>, counts array<long>"


def aligned_rows(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of texts (``links``: places in the pairs of their part) and of parts (``pairs``, ``counts``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(path_a, path_b)
        task = TaskContext.get().partitionId() << 36
        blocks_of, taken, part, first, row = [], 0, task, task, task
        schema = pa.schema([(n, pa.int64()) for n in ("part", "row", "doc_id", *NUMBERS)] + [("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

        def flush() -> Iterator[list]:
            # The blocks' own distinct pairs become those of the part.
            sizes = [len(own) for own, _, _ in blocks_of]
            found, place = np.unique(np.concatenate([own for own, _, _ in blocks_of]), return_inverse=True)
            counts = np.zeros(len(found), np.int64)
            np.add.at(counts, place, np.concatenate([n for _, n, _ in blocks_of]))
            row, place = first, place.astype(np.int32)
            for (_, _, texts), now in zip(blocks_of, np.split(place, np.cumsum(sizes)[:-1]), strict=True):
                for own, told in texts:
                    for at in range(0, max(len(own), 1), LINKS):
                        numbers = told if at == 0 else [told[0], *[0] * len(NUMBERS), None]
                        yield [part, row, *numbers, now[own[at : at + LINKS]], None, None]
                    row += 1
            if len(found):
                yield [part, None, None, *[None] * len(NUMBERS), None, None, found, counts]

        def packed(rows: Iterator[list], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
            now, size = [], 0
            for values in rows:
                now.append(values)
                size += 100 + sum(len(v) * 8 for v in values[-3:] if v is not None)
                if size > most:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*now, strict=True), schema, strict=True)], schema=schema)
                    now, size = [], 0
            if now:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*now, strict=True), schema, strict=True)], schema=schema)

        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            pairs, out = aligned(pair, [t or "" for t in batch.column("text").to_pylist()])
            own, place, counts = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            columns = zip(batch.column("doc_id").to_pylist(), *(out[n].tolist() for n in NUMBERS), out["groups_sha256"], strict=True)
            links_of = np.split(place.astype(np.int32), np.cumsum([len(p) for p in pairs])[:-1])
            blocks_of.append((own, counts, list(zip(links_of, map(list, columns), strict=True))))
            row += len(pairs)
            taken += len(data)
            if taken >= PART_BYTES:
                yield from packed(flush())
                blocks_of, taken, part, first = [], 0, part + 1, row
        if blocks_of:
            yield from packed(flush())

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ROW)


def pair_counts(parts: DataFrame) -> DataFrame:
    """``pair``, its corpus-wide count ``n`` and whether no pair of the same B id has more (``best``)."""
    counts = parts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
    """``n_best`` and ``count_sum`` of each row of a part, from the counts of the part's pairs by place."""
    n, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)
    place = told.column("place").to_numpy()
    n[place], best[place] = told.column("n").to_numpy(), told.column("best").to_numpy()
    own = rows.column("links").combine_chunks()
    own = own.chunk(0) if isinstance(own, pa.ChunkedArray) else own
    bounds, values = own.offsets.to_numpy().astype(np.int64), own.values.to_numpy()
    out = [np.diff(np.concatenate([[0], np.cumsum(x[values])])[bounds]) for x in (best, n)]
    return rows.drop_columns(["part", "links"]).append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1]))


def alignments(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id``, token, group, link and overlap numbers, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row."""
    rows = kept(aligned_rows(documents, path_a, path_b), "alignment-rows")
    parts = rows.filter("pairs IS NOT NULL").select("part", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "own"))
    parts = parts.select("part", "place", F.col("own.pairs").alias("pair"), F.col("own.counts").alias("n"))
    told = parts.drop("n").join(pair_counts(parts), "pair").select("part", "place", "n", "best")
    # The same table twice: its column goes by another name here.
    told = told.withColumnRenamed("part", "of_part")
    texts = rows.filter("row IS NOT NULL").select("part", "row", "doc_id", *NUMBERS, "groups_sha256", "links")
    schema = "row long, doc_id long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string, n_best long, count_sum long"
    # A part is bounded in bytes, so a group of the cogroup is too.
    summed = texts.groupBy("part").cogroup(told.groupBy("of_part")).applyInArrow(_summed, schema)
    return summed.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(n).alias(n) for n in NUMBERS), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.max("groups_sha256").alias("groups_sha256")
    ).drop("row")
