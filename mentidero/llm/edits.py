"""Edit-aware token counts: a segment tree over the pre-tokens of each document, kept as a table.

A leaf holds a run of pre-tokens: text between two places where the pattern starts a new match whatever
stands around (see bpe.py). The tree's inner nodes are sums of code points and of tokens. An edit walks down
by code points to the leaves it touches, takes the neighbours whose border it may have disturbed, encodes
only that region again, and updates the sums on the paths to the root.

Defined results: a null or empty text is one empty leaf with 0 tokens. Edits apply in array order, each to
the text the one before left; places outside the text are moved to its ends; null edits and null replacement
texts remove nothing and insert nothing. Repeated rows have a tree each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.llm.bpe import SAFE, encode_text, load_encoding, pieces

LEAF = 128  # code points a leaf is given at least, where the text has safe places
EDITS = "array<struct<start: bigint, stop: bigint, text: string>>"


class CountTree:
    """Leaves of one text with sums of code points and tokens above them."""

    def __init__(self, encoding: tiktoken.Encoding, leaves: list[str], tokens: list[int]):
        self.encoding, self.leaves = encoding, list(leaves)
        self.size = 1
        while self.size < len(leaves):
            self.size *= 2
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        self.sums[self.size : self.size + len(leaves), 0] = [len(leaf) for leaf in leaves]
        self.sums[self.size : self.size + len(leaves), 1] = tokens
        for node in range(self.size - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
        self.encoded_chars = 0

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def locate(self, place: int) -> tuple[int, int]:
        """The leaf that holds a code point, and the code points before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if place >= before + self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        return node - self.size, before

    def put(self, leaf: int, text: str) -> None:
        tokens = len(encode_text(self.encoding, text)) if text else 0
        self.encoded_chars += len(text)
        self.leaves[leaf] = text
        node = leaf + self.size
        self.sums[node] = len(text), tokens
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _filled(self, leaf: int, step: int) -> int | None:
        """The next leaf with text in a direction."""
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace code points `start` to `stop` by `text`."""
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        last_char = max(self.n_chars - 1, 0)
        first, before = self.locate(min(start, last_char))
        last, before_last = (first, before) if stop <= start else self.locate(stop - 1)
        head = self.leaves[first][: start - before]
        tail = self.leaves[last][max(stop, start) - before_last :]
        region = head + text + tail
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self.put(leaf, "")
        # Boundary context: a border stays only where the pattern must start a match there.
        left = self._filled(first, -1)
        while left is not None and not SAFE.match(self.leaves[left][-1] + region[:2], 1):
            region = self.leaves[left] + region
            self.put(left, "")
            left = self._filled(left, -1)
        right = self._filled(first, 1)
        while right is not None and not SAFE.match(region[-1:] + self.leaves[right][:2], len(region[-1:])):
            region += self.leaves[right]
            self.put(right, "")
            right = self._filled(right, 1)
        self.put(first, region)


def build_tree(encoding: tiktoken.Encoding, text: str, leaf: int = LEAF) -> CountTree:
    leaves = list(pieces(text, leaf))
    return CountTree(encoding, leaves, [len(encode_text(encoding, x)) if x else 0 for x in leaves])


def build_trees(documents: DataFrame, ranks_path: str, pattern: str, keep: str = "doc_id") -> DataFrame:
    """The kept table: per row the key, `leaves` (texts in order), `leaf_tokens`, and n_tokens at the root."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path, pattern)
        for batch in batches:
            trees = [build_tree(encoding, value.as_py() or "") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([t.leaves for t in trees], pa.list_(pa.string())),
                    pa.array([t.sums[t.size : t.size + len(t.leaves), 1].tolist() for t in trees], pa.list_(pa.int64())),
                    pa.array([t.n_tokens for t in trees], pa.int64()),
                ],
                names=[keep, "leaves", "leaf_tokens", "n_tokens"],
            )

    kind = documents.schema[keep].dataType.simpleString()
    schema = f"`{keep}` {kind}, leaves array<string>, leaf_tokens array<bigint>, n_tokens bigint"
    return documents.select(keep, F.col("text").cast("string")).mapInArrow(build, schema)


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, keep: str = "doc_id", edits: str = "edits") -> DataFrame:
    """Trees after the edits in column `edits`, with tokens before and after and the code points encoded anew."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path, pattern)
        for batch in batches:
            done = []
            for leaves, tokens, wanted in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                tree = CountTree(encoding, leaves or [""], tokens or [0])
                before = tree.n_tokens
                for e in wanted or []:
                    if e is not None and e["start"] is not None and e["stop"] is not None:
                        tree.edit(e["start"], e["stop"], e["text"] or "")
                done.append((tree, before))
            trees_after = [t for t, _ in done]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([t.leaves for t in trees_after], pa.list_(pa.string())),
                    pa.array([t.sums[t.size : t.size + len(t.leaves), 1].tolist() for t in trees_after], pa.list_(pa.int64())),
                    pa.array([before for _, before in done], pa.int64()),
                    pa.array([t.n_tokens for t in trees_after], pa.int64()),
                    pa.array([t.n_chars for t in trees_after], pa.int64()),
                    pa.array([t.encoded_chars for t in trees_after], pa.int64()),
                ],
                names=[keep, "leaves", "leaf_tokens", "tokens_before", "n_tokens", "n_chars", "encoded_chars"],
            )

    kind = trees.schema[keep].dataType.simpleString()
    schema = (
        f"`{keep}` {kind}, leaves array<string>, leaf_tokens array<bigint>, tokens_before bigint, n_tokens bigint, "
        "n_chars bigint, encoded_chars bigint"
    )
    return trees.select(keep, "leaves", "leaf_tokens", F.col(edits).cast(EDITS)).mapInArrow(apply, schema)


def sample_edits(n_chars: Column, key: Column) -> Column:
    """Three edits of a document, derived from its length and key: a replaced stretch, a deletion in the
    first half and an insertion in the second."""

    def edit(start: Column, length: int, text: str) -> Column:
        return F.struct(
            start.cast("bigint").alias("start"), (start + length).cast("bigint").alias("stop"), F.lit(text).alias("text")
        )

    place = lambda seed, n: F.pmod(F.xxhash64(key, F.lit(seed)), F.greatest(n, F.lit(1)))
    half = F.floor(n_chars / 2)
    return F.array(
        edit(place(1, n_chars), 12, "it's 2024, 'll"), edit(place(2, half), 30, ""), edit(half + place(3, half), 0, "  new\n\nwords")
    )
