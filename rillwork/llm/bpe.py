"""Encoding of a whole corpus with a byte-level BPE vocabulary.

Corpus-level merge replay. The corpus is cut into words by the tokenizer's pattern
once; every distinct word of the corpus is encoded once. The words of a vocabulary
partition lie in one symbol array with links to their neighbours, an inverted index
leads from each token pair to the positions where it stands, and every merge is
applied in rank order to all its positions at once. Only the touched neighbours get new
pairs. The ids then go back to the documents block by block.

A block is a bounded run of one input partition: its documents are kept as numbers of
the block's own word list, so neither words nor texts are shuffled with the documents.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.runtime import materialize

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Characters in a block (a longer text is a block of its own).
BLOCK_CHARS = 4_000_000
#: Words of a vocabulary partition, and their bytes.
WORDS_PER_TASK, BYTES_PER_TASK = 400_000, 4_000_000

# Fixed value: the public pre-tokenization pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Merge table: pair keys in sorted order with their ranks, and the id of each result."""

    def __init__(self, text: str) -> None:
        model = json.loads(text)["model"]
        vocab = model["vocab"]
        self.base = np.zeros(256, np.int32)
        for ch, b in byte_symbols().items():
            self.base[b] = vocab[ch]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.order = np.argsort(key)
        self.sorted = key[self.order]
        self.left, self.right = (key >> 20).astype(np.int32), (key & 0xFFFFF).astype(np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it doesn't merge."""
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
        return np.where(self.sorted[at] == key, self.order[at], -1)


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words: flat ids and the offsets of the words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    n = int(offsets[-1])
    if not n:
        return np.zeros(0, np.int32), offsets
    # One slot of padding at each end; a word's first and last symbol have no neighbour.
    tok = np.full(n + 2, -1, np.int32)
    tok[1:-1] = merges.base[np.frombuffer(b"".join(words), np.uint8)]
    nxt = np.arange(1, n + 3, dtype=np.int64)
    prv = np.arange(-1, n + 1, dtype=np.int64)
    full = sizes > 0
    nxt[offsets[1:][full]] = n + 1
    prv[offsets[:-1][full] + 1] = 0
    tok[0] = tok[n + 1] = -1

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        r = merges.ranks(tok[at], tok[nxt[at]])
        at, r = at[r >= 0], r[r >= 0]
        if not len(at):
            return
        if len(at) == 1:
            groups = [(int(r[0]), at)]
        else:
            o = np.argsort(r, kind="stable")
            r, at = r[o], at[o]
            cut = np.flatnonzero(r[1:] != r[:-1]) + 1
            groups = zip(r[np.concatenate([[0], cut])].tolist(), np.split(at, cut))
        for k, p in groups:
            if k in index:
                index[k].append(p)
            else:
                index[k] = [p]
                heapq.heappush(heap, k)

    at = np.arange(1, n + 1)
    add(at[nxt[at] <= n])
    while heap:
        k = heapq.heappop(heap)
        held = index.pop(k)
        a, b, c = merges.left[k], merges.right[k], merges.result[k]
        p = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        q = nxt[p]
        p = p[(tok[p] == a) & (tok[q] == b)]
        if a == b and len(p) > 1:  # aaa: from the left, each symbol once
            p.sort()
            keep, last = np.ones(len(p), bool), -1
            for i, (x, y) in enumerate(zip(p.tolist(), nxt[p].tolist())):
                if x == last:
                    keep[i] = False
                else:
                    last = y
            p = p[keep]
        if not len(p):
            continue
        q = nxt[p]
        after = nxt[q]
        tok[p], tok[q] = c, -2
        nxt[p] = after
        inside = after <= n
        prv[after[inside]] = p[inside]
        left = prv[p]
        add(np.unique(np.concatenate([left[left > 0], p[inside]])) if len(p) > 1 else np.concatenate([left[left > 0], p[inside]]))
    live = tok[1:-1] >= 0
    ends = np.concatenate([[0], np.cumsum(live)])
    return tok[1:-1][live], ends[offsets]


def _ragged(flat: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the picked runs, and their lengths."""
    size = (offsets[1:] - offsets[:-1])[pick]
    total = int(size.sum())
    start = np.repeat(offsets[:-1][pick] - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(pick) else offsets[:0], size)
    return flat[start + np.arange(total)], size


def encode(df: DataFrame, id_: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Token ids of every text: ``id_, ids array<int>``, one row for each input row.

    Null and empty texts give an empty list; nothing is trimmed or normalized, and the
    strings of special tokens are ordinary text. Texts of any length are encoded whole.
    vocabulary: a tokenizer file with ``model.vocab`` and ``model.merges`` on the driver;
    its contents (of fixed size) are broadcast.
    """
    import regex

    spark = df.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        table = spark.sparkContext.broadcast(f.read())

    cut_schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("nums", pa.list_(pa.int32())), ("num", pa.int32()), ("word", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find = regex.compile(PATTERN).findall
        part, k = TaskContext.get().partitionId(), 0

        def flush(docs: list, flat: list, sizes: list, numbers: dict) -> pa.RecordBatch:
            nonlocal k
            block = part << 32 | k
            k += 1
            d, w = len(docs), len(numbers)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int32)), pa.array(np.fromiter(flat, np.int32, len(flat))))
            words = [x.encode("utf-8", "surrogatepass") for x in numbers]
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(d + w, block)), pa.array(docs + [None] * w, pa.int64()),
                pa.concat_arrays([lists, pa.nulls(w, lists.type)]),
                pa.array([None] * d + list(range(w)), pa.int32()), pa.array([None] * d + words, pa.binary())], schema=cut_schema)

        docs, flat, sizes, numbers, chars = [], [], [], {}, 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = find(t) if t else []
                flat.extend([numbers.setdefault(x, len(numbers)) for x in ws])
                docs.append(i)
                sizes.append(len(ws))
                chars += len(t or "")
                if chars >= BLOCK_CHARS:
                    yield flush(docs, flat, sizes, numbers)
                    docs, flat, sizes, numbers, chars = [], [], [], {}, 0
        if docs:
            yield flush(docs, flat, sizes, numbers)

    src = df.select(F.col(id_).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t"))
    cuts = materialize(src.mapInArrow(cut, "block bigint, doc_id bigint, nums array<int>, num int, word binary"), "cuts")
    dictionary = cuts.where("word is not null").select("block", "num", "word")
    held = dictionary.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("word")), F.lit(0)).alias("size"), F.countDistinct("block").alias("blocks")).first()

    ids_schema = pa.schema([("block", pa.int64()), ("num", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        d = rows.column("word").combine_chunks().dictionary_encode()
        flat, offsets = replay(d.dictionary.to_pylist(), Merges(table.value))
        pick = d.indices.to_numpy(zero_copy_only=False)
        block, num = rows.column("block").combine_chunks(), rows.column("num").combine_chunks()
        for lo in range(0, len(pick), 100_000):
            ids, size = _ragged(flat, offsets, pick[lo : lo + 100_000])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([block.slice(lo, 100_000), num.slice(lo, 100_000), lists], schema=ids_schema)

    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, -(-held.n // WORDS_PER_TASK), -(-held.size // BYTES_PER_TASK), min(cores, -(-held.n // 20_000)))
    coded = dictionary.repartition(tasks, "word").mapInArrow(merge, "block bigint, num int, ids array<int>")

    out_schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def back(docs: pa.Table, words: pa.Table) -> pa.Table:
        num = words.column("num").combine_chunks().to_numpy(zero_copy_only=False)
        ids = words.column("ids").combine_chunks()
        lens = np.zeros(len(num), np.int64)
        starts = np.zeros(len(num), np.int64)
        off = ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        starts[num], lens[num] = off[:-1], off[1:] - off[:-1]
        vals = ids.values.to_numpy(zero_copy_only=False)
        nums = docs.column("nums").combine_chunks()
        noff = nums.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        pick = nums.values.to_numpy(zero_copy_only=False)[noff[0] : noff[-1]]
        size = lens[pick]
        run = np.concatenate([[0], np.cumsum(size)])
        flat = vals[np.repeat(starts[pick] - run[:-1], size) + np.arange(run[-1])] if len(pick) else np.zeros(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(run[noff - noff[0]].astype(np.int32)), pa.array(flat.astype(np.int32)))
        return pa.table([docs.column("doc_id").combine_chunks(), lists], schema=out_schema)

    # A task for each block: their number grows with the corpus and not their size. A given number is not coalesced.
    parts = max(1, held.blocks)
    texts = cuts.where("word is null").select("block", "doc_id", "nums").repartition(parts, "block")
    coded = coded.repartition(parts, "block")
    out = texts.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(back, "doc_id bigint, ids array<int>")
    return out.withColumnRenamed("doc_id", id_)
