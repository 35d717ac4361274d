"""Order-preserving packing of tokenised documents by dynamic programming.

A task's documents, in their order, form one stream of tokens (each document's
ids, then the end id).  The stream is cut into sequences of at most ``limit``
tokens.  Cuts are allowed at document ends (free), at sentence ends and, where
no boundary is near, inside sentences (each at a cost in tokens).  Dynamic
programming over these points minimises padding plus cut costs:

    best[j] = cost[j] + min over i of best[i] + padding(point[j] - point[i])

Padding is ``limit - length``, but 0 where the length is a power of two.  The
linear part is a minimum over a sliding window, kept by a monotone queue, so a
point costs constant time.

The stream is solved in blocks of ``block`` tokens; the last sequences of a
block are solved again with the next one.  A task holds one block.  Sequences
never span tasks, and a task's result depends on its own rows only.

Tokenisation gives the ids of the byte-level BPE file exactly; a text is encoded
in one call.

Defined results: null or empty text is the end id alone; null ids, repeated
rows and extra columns are carried as they are or ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column

LIMIT = 2048
END_ID = 1
SENTENCE_COST = 4
WORD_COST = 16
STEP = 32            # distance of the points inside sentences
BLOCK = 1 << 18
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

# Fixed value: the pre-token pattern of the byte-level BPE files.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------- tokens

def _byte_letters() -> dict[str, int]:
    """The letters in which byte-level BPE files write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Ids of a byte-level BPE file (``tokenizers`` JSON), as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self._bpe = tiktoken.Encoding(path, pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        self.ends_sentence = np.zeros(size, bool)
        for token, i in ranks.items():
            self.ends_sentence[i] = b"\n" in token or token.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?")

    def encode(self, text: str) -> bytes:
        return self._bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


# ---------------------------------------------------------------- cuts

def best_cuts(points: np.ndarray, costs: np.ndarray, limit: int) -> np.ndarray:
    """Numbers of the points at which the cheapest cutting cuts, the first (0) and last included.

    ``points`` rise from 0, at most ``limit`` apart; ``costs`` are those of a cut there.
    """
    m = len(points)
    pairs_j, pairs_i = [], []
    size = 1
    while size < limit:
        i = np.searchsorted(points, points - size)
        j = np.flatnonzero((points >= size) & (points[np.minimum(i, m - 1)] == points - size))
        pairs_j.append(j)
        pairs_i.append(i[j])
        size *= 2
    pj, pi = np.concatenate(pairs_j), np.concatenate(pairs_i)
    order = np.argsort(pj, kind="stable")
    pj, pi = pj[order].tolist() + [m], pi[order].tolist()
    p, c = points.tolist(), costs.tolist()
    best, prev, level = [0] * m, [0] * m, [0] * m
    level[0] = p[0]
    queue, head, at = [0], 0, 0
    for j in range(1, m):
        x = p[j]
        low = x - limit
        while p[queue[head]] < low:
            head += 1
        i = queue[head]
        value = level[i] - low
        while pj[at] == j:
            k = pi[at]
            if best[k] < value:
                value, i = best[k], k
            at += 1
        value += c[j]
        best[j], prev[j] = value, i
        f = level[j] = value + x
        while len(queue) > head and level[queue[-1]] >= f:
            queue.pop()
        queue.append(j)
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(prev[cuts[-1]])
    return np.array(cuts[::-1])


def padded(length: int, limit: int) -> int:
    return length if length & (length - 1) == 0 else limit


class Packer:
    """Cuts one task's stream; ``add`` and ``finish`` return finished pieces."""

    def __init__(self, ends_sentence: np.ndarray, limit: int = LIMIT, sentence_cost: int = SENTENCE_COST,
                 word_cost: int = WORD_COST, block: int = BLOCK, first_sequence: int = 0):
        self.ends, self.limit, self.block = ends_sentence, limit, block
        self.costs = sentence_cost, word_cost
        self.sequence = first_sequence
        self.docs: list = []      # doc id, tokens before, ids, tokens of the document
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> list | None:
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)
        return self._cut(False) if self.held >= self.block else None

    def finish(self) -> list | None:
        return self._cut(True) if self.held else None

    def _points(self, ids: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = np.union1d(np.concatenate([[0], doc_ends]), np.flatnonzero(self.ends[ids]) + 1)
        gaps = np.diff(base)
        wide = np.flatnonzero(gaps > 2 * STEP)
        more = [np.arange(base[i] + STEP, base[i + 1], STEP) for i in wide]
        points = np.union1d(base, np.concatenate(more)) if more else base
        costs = np.full(len(points), self.costs[1])
        costs[np.searchsorted(points, base)] = self.costs[0]
        costs[np.searchsorted(points, doc_ends)] = 0
        return points, costs

    def _cut(self, last: bool) -> list | None:
        sizes = np.array([len(d[2]) for d in self.docs])
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum(sizes)
        points, costs = self._points(ids, ends)
        cuts = points[best_cuts(points, costs, self.limit)]
        if not last:
            cuts = cuts[:-2] if len(cuts) > 3 else cuts[:1]
        stop = cuts[-1]
        edges = np.union1d(cuts, ends[ends < stop])
        lo, hi = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, lo, "right")
        seq = np.searchsorted(cuts, lo, "right") - 1
        begins = ends - sizes
        raw = ids.astype("<u4").tobytes()
        held = np.array([d[1] for d in self.docs])
        out = [[self.docs[d][0] for d in doc.tolist()], held[doc] + lo - begins[doc], hi - lo,
               [raw[4 * a:4 * b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)],
               np.array([d[3] for d in self.docs])[doc], self.sequence + seq, lo - cuts[seq]]
        self.sequence += len(cuts) - 1
        rest = []
        for (doc_id, before, x, n), a, b in zip(self.docs, begins.tolist(), ends.tolist(), strict=True):
            if b > stop:
                cut = max(0, stop - a)
                rest.append((doc_id, before + cut, x[cut:], n))
        self.docs, self.held = rest, int(ends[-1] - stop)
        return out if len(lo) else None


# ---------------------------------------------------------------- operator

def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, end_id: int = END_ID,
                   sentence_cost: int = SENTENCE_COST, word_cost: int = WORD_COST, block: int = BLOCK,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: its ids (little-endian 32-bit bytes), where it starts
    in its document, and its sequence and place there."""
    arrow = arrow_schema(PIECES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(tokenizer_path)
        packer = Packer(bpe.ends_sentence, limit, sentence_cost, word_cost, block, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], "<u4").tobytes()

        def batch(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)

        for b in batches:
            for doc_id, text in zip(column(b, "id"), column(b, "text"), strict=True):
                out = packer.add(doc_id.as_py(), np.frombuffer(bpe.encode(text.as_py() or "") + end, "<u4"))
                if out:
                    yield batch(out)
        out = packer.finish()
        if out:
            yield batch(out)

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(pack, PIECES)
