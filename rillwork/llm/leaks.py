"""Evaluation texts leaking into training text.

A positional inverted index of the whole corpus, built without any knowledge of the test
side and kept as a table: pages are read down their columns, words are folded to lookalike
classes, and for every block of pages each term has its sorted list of positions
(:func:`build_index`). A page's place in its block is in the block's directory.

The search (:func:`find_leaks`) sums the terms' frequencies out of the index, picks for every
window of a test item its rarest phrases (two terms, next to each other or with one word
between), fetches the lists of those terms alone, and intersects them block by block with
their offsets adjusted, from the rarer term's list. A page is a candidate for an item
where AGREE phrases agree on the place of the item's start, however common they are.
Candidates are read again and aligned word by word from these places, with tolerance for
misread letters and for adverts set in between.

Nothing is held on the driver. The test side is a table; its phrases are cut into
shards of bounded size, each searched against every block that holds its terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm import pages
from rillwork.runtime import materialize, release, spread_join

#: Consecutive words that make a leak.
MIN_WORDS = 12
#: Phrases looked up for each window of MIN_WORDS words, the rarest first.
ANCHORS = 12
#: Phrases that have to agree on the item's place, in one run or in parts of at least PART; by how many words their
#: places may differ from one to the next in a run. A misread word takes four of a window's 21 phrases away.
AGREE, PART, DRIFT = 5, 3, 3
#: Share of a run's words that must be read exactly (after folding).
EXACT = 0.55
#: Words that an advert between two parts of a passage may have where the part behind it is misread; any number else.
ADVERT = 70
#: Length of a phrase whose repetition in other items marks an instruction or question.
SHARED = 6
#: Words of a window that have to lie outside such phrases.
OWN = 9
#: Words of a run for each of its pieces between adverts.
PIECE = 6
#: Words of a block of the index, and phrases of a shard of the test side.
BLOCK_WORDS, SHARD_PHRASES = 2_000_000, 1_000_000
#: Free positions between two pages of a block, more than any phrase's length.
GUARD = 8
_STEP = 4_000_000


def _lists(flat: np.ndarray, offsets: np.ndarray, type_: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, type_))


def invert(docs: list[int], sizes: list[int], codes: np.ndarray, terms: list[str]) -> tuple[pa.Array, ...]:
    """Columns ``term, n, at, docs`` of a block. The row of the empty term is the directory: pages and their first
    positions; ``at`` of the others are a term's positions, each as its distance from the one before."""
    size = np.array(sizes, np.int64)
    start = np.cumsum(size + GUARD) - size
    place = np.arange(len(codes)) + np.repeat(start - (np.cumsum(size) - size), size)
    order = np.argsort(codes, kind="stable")
    at = place[order]
    n = np.bincount(codes, minlength=len(terms))
    first = np.cumsum(n) - n
    gap = np.diff(at, prepend=0)
    gap[first] = at[first]
    offsets = np.concatenate([[0, len(docs)], len(docs) + np.cumsum(n)])
    return (
        pa.array(["", *terms], pa.string()), pa.array(np.concatenate([[0], n])), _lists(np.concatenate([start, gap]).astype(np.int32), offsets, pa.int32()),
        pa.concat_arrays([_lists(np.array(docs, np.int64), np.array([0, len(docs)]), pa.int64()), pa.nulls(len(terms), pa.list_(pa.int64()))]))


def _source(docs: DataFrame) -> DataFrame:
    box = F.transform("lines", lambda l: F.struct(F.coalesce(l["x"], F.lit(0)).alias("x"), F.coalesce(l["y"], F.lit(0)).alias("y")))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), box.alias("lines")).where("doc_id is not null and length(text) > 0")


def build_index(docs: DataFrame) -> DataFrame:
    """Positional inverted index of all pages: ``block, term, n, at, docs`` (see :func:`invert`), written to the shared folder.

    docs: ``doc_id, text, lines`` (boxes with x and y). Rows with a null id, a null or an empty
    text are not in it; a page of any length is indexed whole. A block is a run of one input
    partition of about BLOCK_WORDS words, so building moves no posting between machines.
    """
    names = ["block", "term", "n", "at", "docs"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from array import array

        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        ids, sizes, codes, numbers = [], [], array("i"), {}

        def flush() -> pa.RecordBatch:
            cols = invert(ids, sizes, np.frombuffer(codes, np.int32).astype(np.int64), list(numbers))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers) + 1, part << 32 | k)), *cols], names=names)

        for b in batches:
            for i, t, x, y in pages.read(b):
                ws = pages.words(pages.columns(t, x, y))
                codes.extend([numbers.setdefault(w, len(numbers)) for w in ws])
                ids.append(i)
                sizes.append(len(ws))
                if len(codes) >= BLOCK_WORDS:
                    yield flush()
                    k += 1
                    ids, sizes, codes, numbers = [], [], array("i"), {}
        if len(codes):
            yield flush()

    return materialize(_source(docs).mapInArrow(work, "block bigint, term string, n bigint, at array<int>, docs array<bigint>"), "index")


def prepare_items(items: DataFrame) -> DataFrame:
    """Folded words of the items: ``row, item_id, words, twice, common``.

    ``twice`` are the starts of windows of MIN_WORDS words, ``common`` those of SHARED words,
    that stand in another item too. One row for each distinct text of an item that has a window.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [pages.fold(t or "").split() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["item_id", "words"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and length(text) > 0")
    rows = rows.mapInArrow(fold, "item_id bigint, words array<string>").where(F.size("words") >= MIN_WORDS).distinct().withColumn("row", F.xxhash64("item_id", "words"))
    rows = materialize(rows, "items")
    gram = lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.xxhash64(F.slice("words", i, n)))
    grams = rows.select("row", "item_id", F.posexplode(gram(MIN_WORDS)).alias("pos", "h"), F.lit(MIN_WORDS).alias("n")).unionByName(
        rows.select("row", "item_id", F.posexplode(gram(SHARED)).alias("pos", "h"), F.lit(SHARED).alias("n")))
    again = grams.groupBy("n", "h").agg(F.min("item_id").alias("a"), F.max("item_id").alias("b")).where("a <> b").select("n", "h")
    marked = spread_join(grams, again, ["n", "h"], "left_semi").groupBy("row").agg(
        F.collect_set(F.when(F.col("n") == MIN_WORDS, F.col("pos"))).alias("twice"), F.collect_set(F.when(F.col("n") == SHARED, F.col("pos"))).alias("common"))
    none = F.array().cast("array<int>")
    return rows.join(marked, "row", "left").select("row", "item_id", "words", F.coalesce("twice", none).alias("twice"), F.coalesce("common", none).alias("common"))


def windows(n: int, twice: list[int], common: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of an item of n words may leak, and which words lie outside every shared phrase.

    A window may leak when it stands in no other item and OWN of its words lie outside shared phrases.
    """
    alone, own = np.ones(max(0, n - MIN_WORDS + 1), bool), np.ones(n, bool)
    alone[list(twice)] = False
    for i in common:
        own[i : i + SHARED] = False
    inside = np.concatenate([[0], np.cumsum(own)])
    return alone & (inside[MIN_WORDS:] - inside[: max(0, n - MIN_WORDS + 1)] >= OWN), own


def rarest_phrases(starts: np.ndarray, df: list[int]) -> list[tuple[int, int]]:
    """Position and gap of the ANCHORS rarest phrases of every window, by the frequency of their rarer term."""
    keep: set[tuple[int, int]] = set()
    ps = [(min(df[p], df[p + g]), p, g) for p in range(len(df)) for g in (1, 2) if p + g < len(df) and df[p] and df[p + g]]
    at = [p for _, p, _ in ps]
    for s in np.flatnonzero(starts).tolist():
        lo, hi = np.searchsorted(at, s), np.searchsorted(at, s + MIN_WORDS)
        keep.update((p, g) for _, p, g in sorted(e for e in ps[lo:hi] if e[1] + e[2] < s + MIN_WORDS)[:ANCHORS])
    return sorted(keep)


def choose_anchors(tests: DataFrame, index: DataFrame) -> DataFrame:
    """``row, rare, other, off, pos``: the phrases to look up, the rarer term with its place in the item and the other's offset."""
    words = tests.select("row", F.posexplode("words").alias("pos", "term"))
    # The corpus frequency of every test term, summed over the blocks.
    vocab = materialize(words.select("term").distinct(), "vocabulary")
    freq = index.where("term <> ''").select("term", "n").join(vocab, "term").groupBy("term").agg(F.sum("n").alias("n"))
    df = spread_join(words, freq, ["term"], "left").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n")))).alias("df"))
    rows = tests.join(df, "row").select("row", "words", "twice", "common", F.transform("df", lambda d: d["n"]).alias("df"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for row, ws, twice, common, df in zip(*[c.to_pylist() for c in b.columns]):
                for p, g in rarest_phrases(windows(len(ws), twice, common)[0], df):
                    a, z = (p, p + g) if df[p] <= df[p + g] else (p + g, p)
                    out.append((row, ws[a], ws[z], z - a, a))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()))], names=["row", "rare", "other", "off", "pos"])

    out = materialize(rows.mapInArrow(pick, "row bigint, rare string, other string, off int, pos int"), "phrases")
    release(vocab)
    return out


def intersect(lists: pa.Table, phrases: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Candidates of a block: page, row and seeds (place in the item, shifted by 32 bits, and on the page).

    lists: ``term, at, docs`` with the directory; phrases: ``row, rare, other, off, pos``.
    """
    term, at = lists.column("term").combine_chunks(), lists.column("at").combine_chunks()
    flat = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    begin = at.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    begin = begin - begin[0]
    names = term.to_pylist()
    d = names.index("")
    doc_ids = np.array(lists.column("docs")[d].as_py(), np.int64)
    starts = flat[begin[d] : begin[d + 1]].copy()
    # Distances to positions, list by list.
    run = np.cumsum(flat)
    size = np.diff(begin)
    some = begin[:-1][size > 0]
    place = run - np.repeat(run[some] - flat[some], size[size > 0])
    held = np.repeat(np.arange(len(names)), size)
    words = held != d
    stream = np.full(int(place[words].max(initial=0)) + 2 * GUARD, -1, np.int32)
    stream[place[words]] = held[words]

    number = pa.array(names)
    code = lambda c: np.asarray(pa.compute.index_in(phrases.column(c).combine_chunks(), value_set=number).fill_null(-1))
    rare, other = code("rare").astype(np.int64), code("other").astype(np.int64)
    off, pos, row = (phrases.column(c).to_numpy().astype(np.int64) for c in ("off", "pos", "row"))
    ok = (rare >= 0) & (other >= 0)
    rare, other, off, pos, row = (c[ok] for c in (rare, other, off, pos, row))
    if not len(rare):
        return doc_ids[:0], row, []
    key = (rare * len(names) + other) * 8 + off + 4
    uniq, which = np.unique(key, return_inverse=True)
    u_rare, u_other, u_off = uniq // 8 // len(names), uniq // 8 % len(names), uniq % 8 - 4
    by_phrase = np.argsort(which, kind="stable")
    p_first = np.searchsorted(which[by_phrase], np.arange(len(uniq) + 1))
    # The rarer term's list is walked; the other's is met at its offset.
    n = size[u_rare]
    ends = np.cumsum(n)
    got_p, got_at = [], []
    lo = 0
    while lo < len(uniq):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _STEP, "right")))
        m = n[lo:hi]
        src = np.repeat(begin[u_rare[lo:hi]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        x = place[src]
        hit = np.flatnonzero(stream[x + np.repeat(u_off[lo:hi], m)] == np.repeat(u_other[lo:hi], m))
        got_p.append(np.repeat(np.arange(lo, hi), m)[hit])
        got_at.append(x[hit])
        lo = hi
    hp, hx = np.concatenate(got_p), np.concatenate(got_at)
    m = (p_first[1:] - p_first[:-1])[hp]
    e = by_phrase[np.repeat(p_first[hp] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
    x = np.repeat(hx, m)
    if not len(x):
        return doc_ids[:0], row[:0], []
    rows, r = np.unique(row[e], return_inverse=True)
    doc = np.searchsorted(starts, x, "right") - 1
    i = pos[e]
    o = x - i
    s = np.lexsort((o, r, doc))
    doc, r, o, i, x = doc[s], r[s], o[s], i[s], x[s]
    # Runs of phrases of one page and item whose places differ little from one to the next.
    pair_cut = np.concatenate([[True], (doc[1:] != doc[:-1]) | (r[1:] != r[:-1])])
    begin_run = np.flatnonzero(pair_cut | np.concatenate([[True], o[1:] - o[:-1] > DRIFT]))
    count = np.diff(np.append(begin_run, len(x)))
    pair = np.cumsum(pair_cut) - 1
    # Two parts of a passage around an advert, the second one's words behind the first one's, count together.
    part = begin_run[count >= PART]
    low, high, size_ = np.minimum.reduceat(i, begin_run)[count >= PART], np.maximum.reduceat(i, begin_run)[count >= PART], count[count >= PART]
    both = (pair[part][1:] == pair[part][:-1]) & (np.abs(low[1:] - high[:-1]) <= PIECE) & (o[part][1:] - o[part][:-1] <= ADVERT + DRIFT)
    total = size_.copy()
    total[1:] += np.where(both, size_[:-1], 0)
    # All phrases of such a page and item are places to begin.
    good = np.bincount(pair[part[total >= AGREE]], minlength=pair[-1] + 1) > 0
    keep = good[pair]
    seeds = ((i << 32) + x - starts[doc])[keep]
    first = np.flatnonzero(np.concatenate([[True], pair[keep][1:] != pair[keep][:-1]])) if keep.any() else np.zeros(0, np.int64)
    return doc_ids[doc[keep][first]], rows[r[keep][first]], np.split(seeds, first[1:]) if len(first) else []


def candidates(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc_id, row, seeds``: pages where phrases of an item agree on a place, by intersection of their terms' lists."""
    shards = max(1, -(-phrases.count() // SHARD_PHRASES))
    phrases = phrases.withColumn("shard", F.pmod("row", F.lit(shards)).cast("int"))
    needed = phrases.select("shard", F.explode(F.array("rare", "other")).alias("term")).distinct()
    # The directory of every block goes with each shard.
    needed = materialize(needed.unionByName(needed.select("shard", F.lit("").alias("term")).distinct()), "terms")
    fetched = index.join(needed, "term").select("block", "shard", "term", "at", "docs")
    # A phrase is looked up in the blocks that hold its rarer term.
    where = index.select(F.col("block").alias("in_block"), F.col("term").alias("rare")).join(phrases.withColumnRenamed("shard", "in_shard"), "rare").select("in_block", "in_shard", "row", "rare", "other", "off", "pos")

    def meet(lists: pa.Table, looked: pa.Table) -> pa.Table:
        import pyarrow.compute  # noqa: F401

        d, r, s = intersect(lists, looked) if lists.num_rows and looked.num_rows else ([], [], [])
        return pa.table([pa.array(d, pa.int64()), pa.array(r, pa.int64()), pa.array(list(s), pa.list_(pa.int64()))], names=["doc_id", "row", "seeds"])

    return materialize(fetched.groupBy("block", "shard").cogroup(where.groupBy("in_block", "in_shard")).applyInArrow(meet, "doc_id bigint, row bigint, seeds array<bigint>"), "candidates")


# Results of the comparisons in a task. Plain dicts, as caches of functools reach a worker by their module's name only.
_LETTERS: dict[str, int] = {}
_SAME: dict[tuple[str, str], bool] = {}
_BAD: dict[tuple[str, str], bool] = {}
_MEMO = 1 << 18


def _letters(word: str) -> int:
    """The word's letters as a set of 64 bits."""
    out = _LETTERS.get(word)
    if out is None:
        out = 0
        for ch in word:
            out |= 1 << (ord(ch) & 63)
        if len(_LETTERS) >= _MEMO:
            _LETTERS.clear()
        _LETTERS[word] = out
    return out


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or ``most + 1`` where it is larger."""
    if a == b:
        return 0
    # A change adds or takes one letter each at most.
    if abs(len(a) - len(b)) > most or (_letters(a) ^ _letters(b)).bit_count() > 2 * most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        low = i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
            low = min(low, row[j])
        if low > most:
            return most + 1
    return row[-1]


def _within(memo: dict[tuple[str, str], bool], a: str, b: str, most: int) -> bool:
    out = memo.get((a, b))
    if out is None:
        if len(memo) >= _MEMO:
            memo.clear()
        out = memo[a, b] = distance(a, b, most) <= most
    return out


def same(a: str, b: str) -> bool:
    """Equal but for misread letters: a third of the letters, one at least."""
    if a == b:
        return True
    n = max(len(a), len(b))
    return n > 2 and _within(_SAME, a, b, max(1, n // 3))


def bad(a: str, b: str) -> bool:
    """May ``b`` be a bad misreading of ``a``: half of the letters, one at least?"""
    return _within(_BAD, a, b, max(1, max(len(a), len(b)) // 2))


def positions(doc: list[str]) -> dict[str, list[int]]:
    where: dict[str, list[int]] = defaultdict(list)
    for j, w in enumerate(doc):
        where[w].append(j)
    return where


class _Reader:
    """Follows an item's words over a page in one direction."""

    def __init__(self, item: list[str], doc: list[str], back: bool) -> None:
        self.item, self.doc = (item[::-1], doc[::-1]) if back else (item, doc)
        self.back = back
        self.where: dict[str, list[int]] | None = None

    def step(self, i: int, j: int) -> tuple[int, int] | None:
        """Next (item, page) place when the words before i are matched up to page place j."""
        item, doc = self.item, self.doc
        n, m = len(item), len(doc)
        if j >= m:
            return None
        w, d = item[i], doc[j]
        if w == d or same(w, d):
            return i + 1, j + 1
        if j + 1 < m and abs(len(d) + len(doc[j + 1]) - len(w)) * 3 <= len(w) + 3 and same(w, doc[j + 1] + d if self.back else d + doc[j + 1]):
            return i + 1, j + 2
        if i + 1 < n and len(d) > 4 and abs(len(w) + len(item[i + 1]) - len(d)) * 3 <= len(d) + 3 and same(item[i + 1] + w if self.back else w + item[i + 1], d):
            return i + 2, j + 1
        # One badly misread word between two good ones.
        if j + 2 < m and i + 2 < n and bad(item[i], doc[j]) and same(item[i + 1], doc[j + 1]) and same(item[i + 2], doc[j + 2]):
            return i + 1, j + 1
        return None

    def jump(self, i: int, j: int) -> tuple[int, int] | None:
        """Place behind an advert where the item goes on, and how many words are sure there.

        Three words in a row (or all that are left): with one exact within ADVERT words, all exact
        anywhere further on the page. Else two exact ones within ADVERT words.
        """
        item, doc = self.item, self.doc
        k = min(3, len(item) - i)
        if k < 2:
            return None
        if self.where is None:
            self.where = positions(doc)
        for x in sorted({x - o for o in range(k) for x in self.where.get(item[i + o], ()) if x - o >= j}):
            if x - j >= ADVERT:
                if doc[x : x + k] == item[i : i + k]:
                    return x, k
                continue
            a, b = i, x
            while a < i + k and (nx := self.step(a, b)):
                a, b = nx
            if a >= i + k:
                return x, k
        for x in self.where.get(item[i], ()):
            if j <= x < j + ADVERT and doc[x : x + 2] == item[i : i + 2]:
                return x, 2
        return None

    def walk(self, i: int, j: int, jumps: bool, seen: set[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
        """Where the item's words end that begin at i and j: after the first piece, and after each further one behind an advert."""
        out = []
        while True:
            while i < len(self.item):
                if seen is not None:
                    seen.add((len(self.item) - 1 - i, len(self.doc) - 1 - j) if self.back else (i, j))
                nx = self.step(i, j)
                if nx is None:
                    break
                i, j = nx
            out.append((i, j))
            at = self.jump(i, j) if jumps else None
            if at is None:
                return out
            j, sure = at
            if sure < 3:  # two words are a last piece
                return [*out, (i + sure, j + sure)]


def bag_of(doc: list[str]) -> set[str]:
    """A page's words, and its neighbours as one."""
    return {*doc, *map(str.__add__, doc, doc[1:])}


def aligned(item: list[str], doc: list[str], bag: set[str], alone: np.ndarray, own: np.ndarray, seeds: list[int]) -> tuple[int, int, int, int] | None:
    """A run of MIN_WORDS or more consecutive item words on the page that holds one of the seeds: its bounds in both.

    bag: of :func:`bag_of`; alone, own: of :func:`windows`. Of all the run's words EXACT are read exactly, and of the own words of one of
    its windows that may leak; with adverts between, the run has PIECE words for each piece.
    """
    n, m = len(item), len(doc)
    present = np.cumsum([0, *[w in bag for w in item]])
    if not (alone & (present[MIN_WORDS:] - present[:-MIN_WORDS] >= EXACT * OWN)).any():
        return None  # whatever the order, no window has enough words on the page
    ahead, behind = _Reader(item, doc, False), _Reader(item, doc, True)

    def holds(lo: int, hi: int, b: int, j: int, pieces: int) -> bool:
        if hi - lo < max(MIN_WORDS, PIECE * pieces) or not alone[lo : hi - MIN_WORDS + 1].any():
            return False
        read = doc[b:j]
        there = Counter(read)
        there.update(x + y for x, y in zip(read, read[1:]))
        if (Counter(item[lo:hi]) & there).total() < EXACT * (hi - lo):
            return False
        for s in np.flatnonzero(alone[lo : hi - MIN_WORDS + 1]).tolist():
            mine = Counter(item[k] for k in range(lo + s, lo + s + MIN_WORDS) if own[k])
            if (mine & there).total() >= EXACT * mine.total():
                return True
        return False

    seen: set[tuple[int, int]] = set()
    begun = []
    for jumps in (False, True):
        for z in seeds if not jumps else begun:
            i0, j0 = z >> 32, z & 0xFFFFFFFF
            if not jumps:
                # Another page may have the same id. A run begins where two of three words in a row are read exactly.
                if (i0, j0) in seen or j0 >= m or doc[j0] != item[i0] or not any(
                    0 <= i0 + d < n and 0 <= j0 + d < m and item[i0 + d] == doc[j0 + d] for d in (-2, -1, 1, 2)
                ):
                    continue
            after, before = ahead.walk(i0, j0, jumps, None if jumps else seen), behind.walk(n - i0, m - j0, jumps, None if jumps else seen)
            if not jumps and after[0][0] - (n - before[0][0]) >= PIECE:
                begun.append(z)  # one of a run's pieces is that long
            for f, (hi, j) in enumerate(after):
                for k, (a, b) in enumerate(before):
                    if f + k > 0 or not jumps:
                        if holds(n - a, hi, m - b, j, f + k + 1):
                            return n - a, hi, m - b, j
    return None


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pages that hold MIN_WORDS consecutive words of an item that stand in no other item.

    docs: ``doc_id, text, lines`` (boxes with x and y); items: ``item_id, text``. Returns
    distinct ``doc_id, item_id``. Null and empty texts hold nothing; a text without
    boxes is read in its own order; texts of any length are read whole; items of fewer
    than MIN_WORDS words never leak; several texts of one item count each. Extra columns are
    not read. Neither side's size is bounded.
    """
    tests = materialize(prepare_items(items), "tests")
    index = build_index(docs)
    phrases = choose_anchors(tests, index)
    found = candidates(index, phrases)
    release(index)
    wanted = spread_join(found, tests, ["row"]).select("doc_id", "item_id", "words", "twice", "common", "seeds")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ws, bag = None, [], set()
        parts: dict[tuple, tuple] = {}
        for b in batches:
            out: list[tuple[int, int]] = []
            rest = [b.column(c).to_pylist() for c in ("item_id", "words", "twice", "common", "seeds")]
            for k, (i, t, x, y) in enumerate(pages.read(b)):
                if last != (i, t):
                    last, ws = (i, t), pages.words(pages.columns(t, x, y))
                    bag = bag_of(ws)
                item, words, twice, common, seeds = (c[k] for c in rest)
                key = (len(words), tuple(twice), tuple(common))
                if key not in parts:
                    parts[key] = windows(*key)
                if aligned(words, ws, bag, *parts[key], seeds):
                    out.append((i, item))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([e for _, e in out], pa.int64())], names=["doc_id", "item_id"])

    return _source(docs).join(wanted, "doc_id").mapInArrow(verify, "doc_id bigint, item_id bigint").distinct()
