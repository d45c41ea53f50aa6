"""Filling containers of fixed capacity with texts, along a space-filling curve.

Each document gets its size in tokens of a public tokenizer and a hashed vector: every
word adds, with a sign, to one of ``HASHED`` places. The vector is projected to ``DIMS``
dimensions by a fixed random matrix; since that is linear, each word's part is projected
and the parts are added. The quantised vector is a cell of a grid, and its Hilbert key orders the cells so
that neighbours on the curve are neighbours in the grid. Documents are range-sorted by
key (and id, so that equal keys do not end up in one range) and neighbours are packed
together: along the curve, blocks of ``BLOCK`` items are taken and each block is filled
best-fit decreasing into the containers that are still open.

A text longer than the capacity is cut into full containers and a rest; no other text is
split. Containers never span ranges, and per range only the last few stay partly empty,
so the unused space falls as ranges grow. ``OPEN`` containers of a capacity stay open at
most, the emptiest ones; what is closed is nearly full, and no text is left out by it.

Defined results: null and empty texts have 0 tokens, take no space and get a row in the
first open container; repeated texts are packed as often as they come; an empty table
gives no rows; capacities below 1 or null are left out.
"""

from __future__ import annotations

import base64
import bisect
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lemmaweave.operators.skew import sized

DIMS, BITS, BLOCK, OPEN, HASHED = 3, 10, 4096, 2048, 256
#: The projection: a fixed matrix from the hashed places to the few dimensions.
PROJECTION = np.random.default_rng(8).normal(0, 0.58, (HASHED, DIMS)).astype(np.float32)


def tokenizer(path: str) -> tuple[bytes, str]:
    """Content of a ``.tiktoken`` file and the pattern of its pieces, read by the driver."""
    import public_tokenizers

    with open(path, "rb") as file:
        return file.read(), public_tokenizers.PATTERN


@lru_cache(2)
def encoder(content: bytes, pattern: str) -> Any:
    """The tokenizer of such a content."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Counter_:
    """Token counts and vectors of texts; both are sums over pieces, which are cached."""

    def __init__(self, content: bytes, pattern: str) -> None:
        import regex

        self.encode = encoder(content, pattern).encode_ordinary
        self.pieces = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.at: dict[str, int] = {}
        self.directions = np.zeros((1024, DIMS), np.float32)

    def size(self, text: str) -> tuple[int, np.ndarray]:
        """(tokens, vector) of one text. Byte-pair merges never cross pieces."""
        counts = Counter(self.pieces.findall(text))
        known, at = self.known, self.at
        total, index, weight = 0, [], []
        for piece, n in counts.items():
            tokens = known.get(piece)
            if tokens is None:
                if len(known) > 500_000:
                    known.clear()
                    at.clear()
                tokens = known[piece] = len(self.encode(piece))
            total += tokens * n
            word = piece.strip().lower()
            if len(word) > 3:
                i = at.get(word)
                if i is None:
                    i = at[word] = len(at)
                    if i >= len(self.directions):
                        self.directions = np.concatenate([self.directions, np.zeros_like(self.directions)])
                    seed = xxhash.xxh64_intdigest(word)
                    self.directions[i] = PROJECTION[seed % HASHED] * (1 if seed >> 63 else -1)
                index.append(i)
                weight.append(n)
        if not index:
            return total, np.zeros(DIMS, np.float32)
        w = np.array(weight, np.float32)
        return total, (self.directions[index] * w[:, None]).sum(0) / np.sqrt((w * w).sum())


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of grid cells (rows of DIMS coordinates), after Skilling (2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def measured(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, place): size and Hilbert key of each document.

    ``path`` is read by the driver; the vocabulary, of fixed size, is broadcast.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer(path))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter_(*shared.value)
        for batch in batches:
            sizes, vectors = [], []
            for t in batch[text]:
                n, v = counter.size(t) if t else (0, np.zeros(DIMS, np.float32))
                sizes.append(n)
                vectors.append(v)
            grid = np.array(vectors, np.float32).reshape(-1, DIMS)
            # Means of many directions are near normal; the squash spreads them over the grid.
            cells = np.clip((0.5 + 0.5 * np.tanh(1.2 * grid)) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pd.DataFrame({key: batch[key], "n_tokens": np.array(sizes, np.int64), "place": hilbert(cells)})

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInPandas(read, f"`{key}` {kind}, n_tokens long, place long")


class Shelf:
    """Open containers of one capacity, by free space; best fit takes the fullest that fits."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.made = capacity, 0
        self.open: list[tuple[int, int]] = []  # (free, number), sorted

    def put(self, size: int) -> int:
        at = bisect.bisect_left(self.open, (size, -1))
        if at < len(self.open):
            free, number = self.open.pop(at)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        if free > size:
            bisect.insort(self.open, (free - size, number))
        return number

    def close(self, most: int = OPEN) -> None:
        """Keep only the emptiest containers open: what is nearly full is done."""
        if len(self.open) > most:
            self.open = self.open[-most:]


def packed(sizes: DataFrame, capacities: list[tuple[int, int]], key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """(size_id, container_id, key, part, n_tokens): which text is in which container.

    ``sizes``: what ``measured`` gives, materialised. ``part`` is 0 unless a text exceeds
    the capacity and was cut; container ids hold the range and a number in it.
    """
    usable = [(i, c) for i, c in capacities if c is not None and c >= 1]
    kind = dict(sizes.dtypes)[key]

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        range_ = context.partitionId() if context else 0
        shelves = {i: Shelf(c) for i, c in usable}

        def block(ids: list[Any], tokens: list[int]) -> pd.DataFrame:
            out: list[tuple[int, str, Any, int, int]] = []
            for size_id, shelf in shelves.items():
                items: list[tuple[int, Any, int]] = []
                for d, n in zip(ids, tokens, strict=True):
                    part = 0
                    while n > shelf.capacity:
                        out.append((size_id, f"{size_id}-{range_}-{shelf.put(shelf.capacity)}", d, part, shelf.capacity))
                        n -= shelf.capacity
                        part += 1
                    items.append((n, d, part))
                items.sort(key=lambda x: (-x[0], str(x[1])))
                for n, d, part in items:
                    out.append((size_id, f"{size_id}-{range_}-{shelf.put(n)}", d, part, n))
                shelf.close()
            return pd.DataFrame(out, columns=["size_id", "container_id", key, "part", "n_tokens"])

        ids: list[Any] = []
        tokens: list[int] = []
        for batch in batches:
            ids += batch[key].tolist()
            tokens += batch["n_tokens"].tolist()
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], tokens[:BLOCK])
                ids, tokens = ids[BLOCK:], tokens[BLOCK:]
        if ids:
            yield block(ids, tokens)

    by = [F.col("place"), F.col(key)]
    ordered = (sizes.repartitionByRange(ranges, *by) if ranges else sizes.repartitionByRange(*by)).sortWithinPartitions(*by)
    return ordered.select(key, "n_tokens").mapInPandas(fill, f"size_id int, container_id string, `{key}` {kind}, part int, n_tokens long")


def report(assignment: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, unused share and the fewest containers possible."""
    held = assignment.groupBy("size_id").agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    space = F.col("n_containers") * F.col("capacity_tokens")
    return held.join(sized(capacities.select("size_id", "capacity_tokens").distinct()), "size_id").select("size_id", "n_containers", "n_tokens", (1 - F.col("n_tokens") / space).alias("unused_share"), F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"))
