"""Byte-level BPE as a matching automaton.

The vocabulary is compiled into an Aho-Corasick automaton. Which tokens may stand side by side in
an encoding follows from the merge ranks alone (``BytePairAutomaton.compatible``), and each prefix
of a text has exactly one encoding, so encoding needs no merge loop:

* ``encode`` walks forward by longest matches and backtracks where a pair isn't compatible;
* ``count`` keeps, for every prefix, only its last token and its length in tokens.

Both are linear in the text for a fixed vocabulary.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import spread

#: Where the public vocabularies lie on every node; a parameter of each operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the pattern published with the vocabulary, which splits text before any merge.
PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space as Unicode defines it; the pattern engine's own \s differs at U+001C to U+001F.
SPACE = r"\p{White_Space}"

#: Pieces remembered per Python worker; beyond it the memory is emptied, results don't change.
REMEMBERED = 400_000
#: Longer pieces are encoded each time.
REMEMBERED_LENGTH = 64


def _pattern(piece: str) -> "regex.Pattern":
    inside = piece.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]")
    return regex.compile(inside.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))


def _last_cut(token: bytes, ranks: dict[bytes, int], merged: dict[tuple[int, int], int], limit: int) -> list[int]:
    """Where the two tokens meet that merges of a rank under ``limit`` leave of ``token``."""
    seq = [ranks[token[k : k + 1]] for k in range(len(token))]
    sizes = [1] * len(token)
    while len(seq) > 2:
        best, at = min((merged.get((a, b), limit), k) for k, (a, b) in enumerate(zip(seq, seq[1:])))
        if best >= limit:
            return []
        seq[at : at + 2] = [best]
        sizes[at : at + 2] = [sizes[at] + sizes[at + 1]]
    return sizes[:1]


class BytePairAutomaton:
    """Encoder for a vocabulary in which an id is also the rank of its merge."""

    def __init__(self, vocabulary: str = VOCABULARY, piece: str = PIECE):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = _pattern(piece)
        self.bytes = {i: t for t, i in ranks.items()}
        self.parts, self.merged = self._merges(ranks)
        self.trie = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (i, len(token)))
        self.trie.make_automaton()
        self.shorter = self._prefixes(ranks)
        self._fits: dict[tuple[int, int], bool] = {}
        self._ids: dict[str, list[int]] = {}
        self._counts: dict[str, int] = {}

    @staticmethod
    def _merges(ranks: dict[bytes, int]) -> tuple[dict[int, tuple[int, int]], dict[tuple[int, int], int]]:
        """The two tokens from which each token is merged: what lower ranks make of its bytes."""
        parts, merged = {}, {}
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            cuts = [k for k in range(1, len(token)) if ranks.get(token[:k], i) < i and ranks.get(token[k:], i) < i]
            if len(cuts) != 1:  # several tokens could be its parts: ask the merges
                cuts = _last_cut(token, ranks, merged, i)
            if cuts:
                pair = ranks[token[: cuts[0]]], ranks[token[cuts[0] :]]
                parts[i] = pair
                merged[pair] = i
        return parts, merged

    def _prefixes(self, ranks: dict[bytes, int]) -> dict[int, tuple[int, int] | None]:
        """For each token the longest token that is a proper prefix of it."""
        found = {}
        for token, i in ranks.items():
            found[i] = next(((ranks[token[:n]], n) for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: no merge across the border comes before theirs."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > 4 * REMEMBERED:
                self._fits.clear()
            known = self._fits[left, right] = self._check(left, right)
        return known

    def _check(self, a: int, b: int) -> bool:
        """Undoes merges on both sides of the border, the latest first; while they stand, no token
        that spans the border may have a lower rank than the merge that would have prevented it."""
        before = 1 << 60
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < before:
                return False
            if a > b and a in self.parts:
                before, a = a, self.parts[a][1]
            elif b in self.parts:
                # at equal rank the merge further left happens first
                before, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                before, a = a, self.parts[a][1]
            else:
                return True

    def _longest(self, data: str) -> list[tuple[int, int]]:
        best: list[tuple[int, int]] = [(-1, 0)] * len(data)
        for end, hit in self.trie.iter(data):
            start = end - hit[1] + 1
            if hit[1] > best[start][1]:
                best[start] = hit
        return best

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode().decode("latin-1")
        n, best = len(data), self._longest(data)
        out: list[int] = []
        starts: list[int] = []
        closed = bytearray(n + 1)
        at, hit = 0, best[0]
        while at < n:
            token, size = hit
            if not closed[at + size] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                starts.append(at)
                at += size
                hit = best[at] if at < n else hit
                continue
            less = self.shorter[token]
            while less is None:
                # nothing that starts here can go on: the way to this place is closed
                closed[at] = 1
                at = starts.pop()
                less = self.shorter[out.pop()]
            hit = less
        return out

    def count_piece(self, piece: str) -> int:
        data = piece.encode().decode("latin-1")
        n = len(data)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for end, (token, length) in self.trie.iter(data):
            # exactly one of the tokens that end here is compatible with the prefix before it
            start = end + 1 - length
            if last[end + 1] < 0 and (start == 0 or (last[start] >= 0 and self.compatible(last[start], token))):
                last[end + 1] = token
                size[end + 1] = size[start] + 1
        return size[n]

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; an empty list for null and the empty text."""
        out: list[int] = []
        if not text:
            return out
        known = self._ids
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def count(self, text: str | None) -> int:
        """Number of ids of ``text``, without making them; 0 for null and the empty text."""
        if not text:
            return 0
        known, total = self._counts, 0
        for piece in self.pattern.findall(text):
            n = known.get(piece)
            if n is None:
                n = self.count_piece(piece)
                if len(piece) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = n
            total += n
        return total

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ``ids``, cut from one string by a table of offsets."""
        flat, offsets = self._table()
        ids = np.asarray(ids, dtype=np.int64)
        return b"".join(flat[a:b] for a, b in zip(offsets[ids].tolist(), offsets[ids + 1].tolist()))

    @lru_cache(maxsize=1)  # noqa: B019
    def _table(self) -> tuple[bytes, np.ndarray]:
        tokens = [self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)]
        return b"".join(tokens), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


@lru_cache(maxsize=2)
def automaton(vocabulary: str = VOCABULARY) -> BytePairAutomaton:
    """The compiled vocabulary, once per Python worker."""
    return BytePairAutomaton(vocabulary)


def token_ids(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Ids of a text column. Null and empty texts give an empty list; blank texts are encoded as they
    stand; what looks like a special token is ordinary text."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = automaton(vocabulary).encode
        for texts in batches:
            yield pd.Series([np.array(encode(t), dtype=np.int32) for t in texts], dtype=object)

    return ids(text)


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text column, 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = automaton(vocabulary).count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    return counts(text)


def encode_corpus(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``ids`` of each row of ``docs`` (doc_id, text; other columns are ignored).

    One pass over the text without a shuffle. Rows that repeat a doc_id are kept as they are.
    """
    return spread(docs.select("doc_id", "text")).select("doc_id", token_ids(F.col("text"), vocabulary).alias("ids"))
