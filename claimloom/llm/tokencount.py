"""Token counts by a linear longest-match automaton.

The greedy word-piece rule takes the longest vocabulary entry at the front of a word, then goes on behind it. The automaton is the vocabulary's trie with a failure
link at each node, to where matching goes on after the pieces that are then certain have been popped, and the count of those popped pieces. A
word's count follows from one walk over its symbols, without building a piece.

Symbols are UTF-8 bytes, the last byte of a word being a symbol of its own (256 more), as in vocabularies with word ends. Words are
runs of anything but [\\x20\\x09-\\x0D], with A-Z in lower case. A symbol that no entry begins with counts as one token.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import table

VOCABULARY, WORD_END = public_tokenizers.path("word_bpe_49k.json"), "</w>"
#: Words that a worker remembers the counts of.
REMEMBER = 500_000


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character; others than these move to 256 and above."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def symbols(entry: str, word_end: str = WORD_END) -> list[int]:
    """An entry of the vocabulary file as symbols."""
    table_, end = byte_of_character(), entry.endswith(word_end)
    out = [table_[c] for c in entry.removesuffix(word_end) if c in table_]
    return [*out[:-1], out[-1] + 256] if end and out else out


def vocabulary(path: str = VOCABULARY, word_end: str = WORD_END) -> list[tuple[int, ...]]:
    """Entries without the special ones."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"] for x in spec.get("added_tokens", [])}
    back = byte_of_character()
    out = []
    for entry in spec["model"]["vocab"]:
        body = entry.removesuffix(word_end)
        if entry not in special and body and all(c in back for c in body):
            out.append([back[c] for c in body])
            if body != entry:
                out[-1][-1] += 256
    return [tuple(x) for x in out]


class Automaton:
    def __init__(self, entries: list[tuple[int, ...]]):
        go, token, parents, by = {}, [False], [0], [0]  # go: node * 512 + symbol -> node
        for entry in entries:
            node = 0
            for s in entry:
                key = node * 512 + s
                if (new := go.get(key)) is None:
                    new = go[key] = len(token)
                    token.append(False)
                    parents.append(node)
                    by.append(s)
                node = new
            token[node] = True
        self.go, self.fail, self.popped = go, [-1] * len(token), [0] * len(token)
        depth = [0] * len(token)
        for v in range(1, len(token)):  # parents have smaller numbers
            depth[v] = depth[parents[v]] + 1
        for v in sorted(range(1, len(token)), key=depth.__getitem__):
            if token[v]:
                self.fail[v], self.popped[v] = 0, 1
                continue
            z, n = self.fail[parents[v]], self.popped[parents[v]]
            while z >= 0 and z * 512 + by[v] not in go:
                n += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = go[z * 512 + by[v]], n

    def count(self, word: bytes) -> int:
        """Greedy pieces of a word that isn't empty."""
        go, fail, popped = self.go, self.fail, self.popped
        node = n = 0
        run = [*word[:-1], word[-1] + 256]
        i, start = 0, 0
        while i < len(run):
            new = go.get(node * 512 + run[i])
            if new is not None:
                node, i = new, i + 1
            elif node and fail[node] >= 0:
                n += popped[node]
                node = fail[node]
            elif not node:
                n, i = n + 1, i + 1  # nothing begins with this symbol
            else:
                return self.slow(run)
        while node:
            if fail[node] < 0:
                return self.slow(run)
            n += popped[node]
            node = fail[node]
        return n

    def slow(self, run: list[int]) -> int:
        """The same rule step by step, for words with a symbol that no entry covers."""
        n = i = 0
        while i < len(run):
            node, best, j = 0, 0, i
            while j < len(run) and (node := self.go.get(node * 512 + run[j], -1)) >= 0:
                j += 1
                if self.popped[node] == 1 and self.fail[node] == 0:
                    best = j - i
            i, n = i + max(1, best), n + 1
        return n


_made: dict[tuple[str, str], Automaton] = {}


def automaton(path: str, word_end: str) -> Automaton:
    if (path, word_end) not in _made:
        _made[path, word_end] = Automaton(vocabulary(path, word_end))
    return _made[path, word_end]


def token_counts(docs: DataFrame, path: str = VOCABULARY, word_end: str = WORD_END) -> DataFrame:
    """doc_id, n_words, n_tokens of every row; null and empty texts have none. path: a file at the same place on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, known = automaton(path, word_end).count, {}
        for batch in batches:
            words_, tokens = [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                if len(known) > REMEMBER:
                    known = {}
                n = 0
                for w, times in Counter(words).items():
                    if (c := known.get(w)) is None:
                        c = known[w] = count(w)
                    n += c * times
                words_.append(len(words))
                tokens.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words_, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"))
