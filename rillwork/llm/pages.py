"""Reading order of scanned pages and folding of misread words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa

#: Horizontal distance of two line starts, in pixels, from which they are in different columns.
COLUMN_GAP = 60
_GAP = re.compile(r" {3,}")

# Letters and digits that scans confuse, each with its class's first letter.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "и": "h", "п": "h", "к": "k", "м": "m", "о": "o", "р": "p", "т": "t", "у": "y", "х": "x",
    "з": "3", "э": "3", "ь": "b", "0": "o", "1": "l", "i": "l", "|": "l", "5": "s", "9": "g",
}


class _Fold(dict):
    """Translation of any character: letters and digits folded, blanks kept, the rest dropped."""

    def __missing__(self, code: int) -> str | None:
        ch = chr(code)
        if ch.isspace():
            out: str | None = "\n" if ch == "\n" else " "
        elif ch == "|":
            out = "l"
        else:
            base = "".join(c for c in unicodedata.normalize("NFKD", ch.casefold()) if c.isalnum())
            out = "".join(LOOKALIKES.get(c, c) for c in base) or None
        self[code] = out
        return out


FOLD = _Fold()


def fold(text: str) -> str:
    """Case, accents, punctuation, Unicode form and lookalike letters removed; blanks and line feeds kept."""
    return text.translate(FOLD)


def columns(text: str, xs: list[int], ys: list[int]) -> list[list[str]]:
    """Lines of a page, column by column from left to right, each from top to bottom.

    A line that holds the lines of two columns is cut at its wide gap. Without a box
    for each line the text's own order is kept as one column.
    """
    lines = text.split("\n")
    if len(xs) != len(lines):
        return [lines]
    split = "   " in text
    lo = min(xs)
    if max(xs) - lo < COLUMN_GAP and not split:
        return [lines]
    order = sorted(set(xs))
    starts = [order[0]]
    for a, b in zip(order, order[1:]):
        if b - a >= COLUMN_GAP:
            starts.append(b)
    if len(starts) == 1 and split:
        starts.append(1 << 30)
    cols: list[list[tuple[int, int, str]]] = [[] for _ in starts]
    for i, (s, x, y) in enumerate(zip(lines, xs, ys)):
        c = 0
        while c + 1 < len(starts) and x >= starts[c + 1]:
            c += 1
        if split:
            parts = _GAP.split(s.strip())
            for k, p in enumerate(parts):
                cols[min(c + k, len(cols) - 1)].append((y, i, p))
        else:
            cols[c].append((y, i, s))
    for c in cols:
        c.sort()
    return [[s for _, _, s in c] for c in cols]


_MARK = re.compile("[-­¬=~‐‑‒–—]$")


def words(cols: list[list[str]], known=None) -> list[str]:
    """Folded words in reading order, words broken at line ends joined.

    A mark at the line end joins. Without a mark, the two parts are joined when
    ``known`` holds the whole and not both parts.
    """
    out: list[str] = []
    for lines in cols:
        glue = False
        fresh = False
        for s in lines:
            s = s.rstrip()
            ws = s.translate(FOLD).split()
            if not ws:
                continue
            if fresh and out:
                if glue:
                    ws[0] = out.pop() + ws[0]
                elif known is not None and (a := out[-1] + ws[0]) in known and not (out[-1] in known and ws[0] in known):
                    out.pop()
                    ws[0] = a
            glue = _MARK.search(s) is not None
            fresh = True
            out += ws
    return out


def read(b: pa.RecordBatch) -> Iterator[tuple[int, str | None, list[int], list[int]]]:
    """Id, text, x and y of each line of the rows of a batch ``id, text, lines``."""
    ids, texts, lines = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
    off = lines.offsets.to_numpy(zero_copy_only=False).tolist()
    xs, ys = lines.values.field(0).to_pylist(), lines.values.field(1).to_pylist()
    null = lines.is_null().to_pylist()
    for k, (i, t) in enumerate(zip(ids, texts)):
        x, y = ([], []) if null[k] else (xs[off[k] : off[k + 1]], ys[off[k] : off[k + 1]])
        yield i, t, x, y
