"""Token ids of a byte-level vocabulary, as the tokenizers library gives them."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lumenframe.llm.pieces import PRE_TOKEN, Cache, pieces
from lumenframe.llm.token_count import byte_symbols

SLICE_BYTES = 4 << 20  # text of a batch that is tokenised at once; a longer text goes alone
END_OF_LATIN = "ɐ"
# Set before a piece that has no space before it: the first of a text, a line feed, what follows one.
MARK = "\x01"
# White space, as in pieces.py, but for the space and the line feed.
_RARE_SPACE = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN = rf"\A\z|\A[ \n]|[ \n]\z|[ \n][ \n]|[\x01{_RARE_SPACE}]"
PLAIN = r"\A\x01?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+[.,;:!?]?\z"


def take_runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]``, one after the other."""
    shift = start - (np.cumsum(size) - size)
    return flat[np.repeat(shift, size) + np.arange(int(size.sum()))]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each; a longer text is a part of its own."""
    size = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, at = np.cumsum(size), 0
    while at < len(size):
        end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE_BYTES, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()


class TokenIds:
    """Ids of a tokenizers .json file.

    ``flat`` is for many texts: those with single spaces and line feeds between words are cut into
    words by Arrow, each distinct word of the slice is tokenised once, and an index puts the ids
    of all texts together. Plain Latin words are tokenised together, the other ones by the
    library. Texts with other white space or special strings go piece by piece through a bounded
    cache.
    """

    def __init__(self, path: str, cache: int = 300_000, word_cache: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        # A special string with white space could arise only where words are joined.
        split = not any(c.isspace() for s in self.special for c in s)
        self.feed = self.lib.encode("\n", add_special_tokens=False).ids if split else []
        self.word = Cache(lambda w: self.encode([w])[0], word_cache)
        self.piece = Cache(lambda p: b"".join(map(self.word.__getitem__, self.pre_tokens(p))), cache)
        self.merger = self._merger(path) if len(self.feed) == 1 else None

    @staticmethod
    def _merger(path: str):
        """A faster merger over the same vocabulary, if its ids are the ranks of its merges."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(p)] for p in pairs]
        added = {t["content"] for t in spec["added_tokens"]}
        if ids != sorted(set(ids)) or len(set(model["vocab"]) - added) != 256 + len(ids):
            return None
        import tiktoken

        byte = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in added}
        return tiktoken.Encoding("own", pat_str=PRE_TOKEN.pattern.replace("\\x85", "\\x{85}").replace("\\xa0", "\\x{a0}"), mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens. A line feed before a space and a word is always a pre-token, so
        words that begin with a space go to the library a few a time, a line feed between them."""
        spaced, out = [w for w in words if w[0] == " " and w[1:] and not w[1:].isspace()], {}
        if len(self.feed) == 1:
            rows = ["\n".join(spaced[i : i + 16]) for i in range(0, len(spaced), 16)]
            for i, e in enumerate(self.lib.encode_batch_fast(rows, add_special_tokens=False)):
                ids = np.array(e.ids, self.kind)
                ends = [*(np.flatnonzero(ids == self.feed[0])).tolist(), len(ids)]
                own = spaced[16 * i : 16 * i + 16]
                if len(ends) == len(own):
                    raw, size, at = ids.tobytes(), self.kind.itemsize, 0
                    for w, end in zip(own, ends, strict=True):
                        out[w] = raw[at * size : end * size]
                        at = end + 1
        alone = [w for w in words if w not in out]
        out.update(zip(alone, self.encode(alone), strict=True))
        return [out[w] for w in words]

    @staticmethod
    def pre_tokens(piece: str) -> list[str]:
        """The pre-tokens of a piece with the space before it. A plain word is one, with a mark
        after it two; letters below U+0250 are the same in every version of Unicode."""
        if piece < END_OF_LATIN and max(piece, default=END_OF_LATIN) < END_OF_LATIN:
            if piece.isalpha():
                return [" " + piece]
            if piece[-1] in ".,;:!?" and piece[:-1].isalpha():
                return [" " + piece[:-1], piece[-1]]
        return PRE_TOKEN.findall(" " + piece)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Texts with special strings go to the library whole, others piece by piece; a piece of
        several pre-tokens is put together, so the library sees each pre-token once."""
        cut = [[] if any(s in t for s in self.special) else pieces(t) for t in texts]
        first = self.encode([c[0] if c else t for c, t in zip(cut, texts, strict=True)])
        rest = [c[1:] for c in cut]
        piece, word = self.piece, self.word
        made = {p: self.pre_tokens(p) for p in set().union(*rest) if p not in piece and p not in piece.old}
        fresh = list({w for ws in made.values() for w in ws if w not in word and w not in word.old})
        for w, ids in zip(fresh, self.encode_words(fresh), strict=True):
            word.put(w, ids)
        for p, ws in made.items():
            piece.put(p, word[ws[0]] if len(ws) == 1 else b"".join(map(word.__getitem__, ws)))
        return [b"".join([f, *map(piece.__getitem__, r)]) for f, r in zip(first, rest, strict=True)]

    def plain_words(self, words: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number for each plain word, tokenised together with a line feed between
        them: it is a pre-token of its own there, and in no word."""
        if not len(words):
            return np.empty(0, self.kind), np.empty(0, np.int64)
        whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        text = before + pc.binary_join(whole, "\n" + before)[0].as_py()
        ids = np.array(self.merger.encode_ordinary(text), self.kind)
        feeds = np.flatnonzero(ids == self.feed[0])
        if len(feeds) != len(words) - 1:
            return None
        size = np.diff(np.r_[-1, feeds, len(ids)]) - 1
        return np.delete(ids, feeds), size

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, and the first and the number of each word's."""
        bare = pc.starts_with(words, MARK)
        plain = pc.match_substring_regex(words, PLAIN) if self.merger else pa.array(np.zeros(len(words), bool))
        parts, size, rows = [], [], []
        for before, mask in ((" ", pc.and_not(plain, bare)), ("", pc.and_(plain, bare))):
            own = words.filter(mask)
            got = self.plain_words(own if before else pc.utf8_slice_codeunits(own, 1), before)
            if got is None:
                plain = pc.and_not(plain, mask)
                continue
            parts.append(got[0])
            size.append(got[1])
            rows.append(np.flatnonzero(mask.to_numpy(zero_copy_only=False)))
        rest = pc.invert(plain)
        texts = [w[1:] if w[:1] == MARK else " " + w for w in words.filter(rest).to_pylist()]
        ids = [np.array(e.ids, self.kind) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        parts += ids
        size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        rows.append(np.flatnonzero(rest.to_numpy(zero_copy_only=False)))
        n = np.zeros(len(words), np.int64)
        start = np.zeros(len(words), np.int64)
        of, upto = np.concatenate(rows), np.concatenate(size)
        n[of], start[of] = upto, np.cumsum(upto) - upto
        return np.concatenate([np.empty(0, self.kind), *parts]), start, n

    def flat(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) one after the other, and where each text ends, with the
        end id after each text if one is given."""
        odd = pc.match_substring_regex(texts, UNEVEN)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        even_at = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        even = pc.replace_substring(texts.filter(pc.invert(odd)).cast(pa.large_string()), "\n", f" {MARK}\n {MARK}")
        cut = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), even, pa.scalar("", pa.large_string())), " ")
        words = cut.flatten().dictionary_encode()
        ids, first, number = self.distinct(words.dictionary.cast(pa.string()))
        index = words.indices.to_numpy()
        size = number[index]
        ids = take_runs(ids, first[index], size)
        # Words come in the texts' order, so the ends of words give the ends of texts.
        offsets = cut.offsets.to_numpy()
        ends = np.r_[0, np.cumsum(size)][offsets - offsets[0]]
        others = [np.frombuffer(x, self.kind) for x in self(texts.filter(odd).to_pylist())] if len(odd_at) else []
        n, start = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        n[even_at], start[even_at] = np.diff(ends), ends[:-1]
        n[odd_at] = list(map(len, others))
        start[odd_at] = len(ids) + np.cumsum(n[odd_at]) - n[odd_at]
        ids = np.concatenate([ids, *others]) if others else ids
        if end_id is not None:
            start = np.stack([start, np.full(len(n), len(ids))], axis=1).ravel()
            runs = np.stack([n, np.ones(len(n), np.int64)], axis=1).ravel()
            return take_runs(np.r_[ids, self.kind.type(end_id)], start, runs), np.cumsum(n + 1)
        return take_runs(ids, start, n) if others else ids, np.cumsum(n)


@functools.cache
def token_ids(path: str) -> TokenIds:
    return TokenIds(path)
