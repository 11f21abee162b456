"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.pieces import PRE_TOKEN, Cache, pieces


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabulary files: itself
    where printable, else the next free character from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class PairMerger:
    """Counts tokens of a byte-level BPE vocabulary (a tokenizers .json file) without ids."""

    def __init__(self, path: str, cache: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {tuple(p): i for i, p in enumerate(pairs)}
        self.symbols = byte_symbols()
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.word = Cache(self.merge, cache)
        self.piece = Cache(lambda p: self.plain(" " + p), cache)

    def merge(self, word: str) -> int:
        """Tokens of one pre-token: its bytes minus the merges that can be made.

        The symbols form a linked list; a heap holds adjacent pairs by rank, then position. The
        lowest valid pair merges, which makes at most two new pairs.
        """
        sym = [self.symbols[b] for b in word.encode()]
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, heap = self.rank, []
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                heap.append((r, i, sym[i], sym[i + 1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if sym[i] != x or j >= n or sym[j] != y:
                continue  # one side has merged with another neighbour since
            sym[i], sym[j] = x + y, ""
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get((sym[i], sym[k]))
                if r is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[k]))
            h = before[i]
            if h >= 0:
                r = rank.get((sym[h], sym[i]))
                if r is not None:
                    heapq.heappush(heap, (r, h, sym[h], sym[i]))
        return left

    def plain(self, text: str) -> int:
        return sum(map(self.word.__getitem__, PRE_TOKEN.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a text; each special string in it is one token, as the library has it."""
        if not text:
            return 0
        n = 0
        if self.special:
            parts = self.special.split(text)
            n = len(parts) - 1
        else:
            parts = [text]
        for part in parts:
            if part:
                first, *rest = pieces(part)
                n += self.plain(first) + sum(map(self.piece.__getitem__, rest))
        return n


@functools.cache
def _merger(path: str) -> PairMerger:
    return PairMerger(path)


def token_counts(docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Number of tokens of each text under the byte-level BPE file ``vocabulary``.

    A text is cut into pre-tokens; each distinct one is merged once per cache by popping the
    lowest-ranked adjacent pair from a heap over a linked list of symbols. No identifiers arise.
    The work is one pass without a shuffle; a worker holds the merge ranks and bounded caches.

    Returns one row per input row: ``id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than
    ``limit`` tokens). Null and empty texts have no bytes and no tokens. Repeated rows and null
    ids are counted like any other; an empty table gives an empty result; other columns are
    ignored. ``vocabulary`` must be readable at that path on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                n = pa.array([merger.count(t) for t in b.column("text").to_pylist()], pa.int64())
                size = pc.binary_length(b.column("text")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("id"), size, n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    flat = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    out = flat.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id)
