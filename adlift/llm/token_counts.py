"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut into pieces as the tokenizer's file says (special tokens first,
then the byte-level pattern). Within a piece the adjacent pair with the lowest
rank is merged again and again: the pairs wait in a heap, the symbols form a
doubly linked list, and an entry of the heap that no longer describes its place
is skipped. Only the number of merges matters: tokens are symbols less merges,
so no identifier is ever written out. A piece of n bytes takes O(n log n).

Null and empty texts count zero tokens. Repeated rows each get their count.
Texts are never cut; a run of n bytes without a break costs O(n) memory in its
task. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from adlift.llm.frames import ship_package

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Entries of one generation of a worker's memory of counts: bounds its space, never the result.
REMEMBERED = 250_000
#: White space as the pattern of the file format understands it.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")


def _printable_bytes() -> dict[str, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the rest for 256, 257, ..."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Remembered(dict):
    """Counts of strings already seen: when a generation is full it becomes the old one, which is then forgotten."""

    def __init__(self, count):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, key: str) -> int:
        value = self.old.get(key)
        if value is None:
            value = self.count(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteMerges:
    """Counts tokens as the tokenizer described by a byte-level BPE file does."""

    # The byte-level pattern, a fixed value of that file format.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without prefix space or normalizer is needed")
        vocab = model["vocab"]
        self.byte_ids = [0] * 256
        for char, byte in _printable_bytes().items():
            self.byte_ids[byte] = vocab[char]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.cut = regex.compile(self.PATTERN).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.chunks, self.pieces = Remembered(self._chunk), Remembered(self._piece)

    def merges(self, data: bytes) -> int:
        """How many merges the bytes of one piece go through."""
        n = len(data)
        if n < 2:
            return 0
        ids, ranks = self.byte_ids, self.ranks
        symbol = list(map(ids.__getitem__, data))
        if n == 2:
            return (symbol[0] << 32 | symbol[1]) in ranks
        width = n.bit_length()
        mask = (1 << width) - 1
        heap, current = [], [-1] * n
        for i, (a, b) in enumerate(zip(symbol, symbol[1:])):
            found = ranks.get(a << 32 | b)
            if found is not None:
                current[i] = found[0]
                heap.append(found[0] << width | i)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push, done = heapq.heappop, heapq.heappush, 0
        while heap:
            entry = pop(heap)
            i = entry & mask
            if current[i] != entry >> width:
                continue
            j = after[i]
            symbol[i] = ranks[symbol[i] << 32 | symbol[j]][1]
            done += 1
            current[j] = current[i] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks.get(symbol[i] << 32 | symbol[k])
                if found is not None:
                    current[i] = found[0]
                    push(heap, found[0] << width | i)
            h = before[i]
            if h >= 0:
                found = ranks.get(symbol[h] << 32 | symbol[i])
                if found is None:
                    current[h] = -1
                else:
                    current[h] = found[0]
                    push(heap, found[0] << width | h)
        return done

    def _piece(self, piece: str) -> int:
        data = piece.encode()
        return len(data) - self.merges(data)

    def _chunk(self, chunk: str) -> int:
        """Tokens of white space, or of a stretch without it and the blank before."""
        pieces = self.pieces
        return sum([pieces[piece] for piece in self.cut(chunk)])

    def _plain(self, text: str) -> int:
        chunks = self.chunks
        return sum([chunks[chunk] * times for chunk, times in Counter(_CHUNK.findall(text)).items()])

    def count(self, text: str) -> int:
        """Tokens of a text; a special token's string counts as that one token."""
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


_READY: dict[str, ByteMerges] = {}


def _counter(spec: str) -> ByteMerges:
    """The counter of a worker: its memory of pieces outlasts a task."""
    if spec not in _READY:
        _READY[spec] = ByteMerges(spec)
    return _READY[spec]


def token_counts(
    docs: DataFrame, tokenizer_file: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """UTF-8 bytes and tokens of every text, and whether the tokens exceed ``limit``; one pass, no shuffle.

    ``tokenizer_file`` is read here, by the driver, and travels with the tasks.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(spec.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                n_bytes.append(len(value.encode()))
                n_tokens.append(counter.count(value))
            over = [n > limit for n in n_tokens]
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(over, pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    ids = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return ids.mapInArrow(counted, SCHEMA)
