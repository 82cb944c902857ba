"""Deeply nested semi-structured records to related flat tables.

Each record is stream-parsed, without recursion over its depth, into
path-value-ordinal triples. The path is cut at its repeated ancestors: ``grp``
names the repeated ancestor a triple belongs to, ``path`` holds the ordinals on the
way to it (``3.1``: first element in the third element), ``field`` the rest. Every
group is then pivoted into one table that keeps ``record_id`` and ``path`` as link
to its parent.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r'[ \t\n\r]*(?:([{}\[\],:])|("[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+")'
    r"|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))")
_AROUND = "﻿￾ \t\n\r\x0b\x0c\x00\x85\xa0  ​　"


def events(text: str) -> Iterator[tuple[str, str | None]]:
    """Events of one JSON text: ``{ } [ ]``, ``k`` with a key, ``s`` string, ``n`` other scalar, ``0`` null.

    Raises ValueError where the text is not valid JSON. Uses memory in proportion to
    the depth only.
    """
    pos, end, stack = 0, len(text), []
    want = "value"  # value | first (value or ]) | key | firstkey (key or }) | colon | after
    while True:
        if want == "after" and not stack:
            if text[pos:].strip(" \t\n\r"):
                raise ValueError("text after the value")
            return
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(f"no JSON at {pos} of {end}")
        pos = m.end()
        p, s, num, word = m.groups()
        if want in ("value", "first"):
            if p == "{":
                stack.append("{")
                want = "firstkey"
                yield "{", None
            elif p == "[":
                stack.append("[")
                want = "first"
                yield "[", None
            elif p == "]" and want == "first":
                stack.pop()
                want = "after"
                yield "]", None
            elif p:
                raise ValueError(f"unexpected {p} at {pos}")
            else:
                want = "after"
                if s is not None:
                    yield "s", json.loads(s) if "\\" in s else s[1:-1]
                elif word == "null":
                    yield "0", None
                else:
                    yield "n", num or word
        elif want in ("key", "firstkey"):
            if s is not None:
                want = "colon"
                yield "k", json.loads(s) if "\\" in s else s[1:-1]
            elif p == "}" and want == "firstkey":
                stack.pop()
                want = "after"
                yield "}", None
            else:
                raise ValueError(f"no key at {pos}")
        elif want == "colon":
            if p != ":":
                raise ValueError(f"no colon at {pos}")
            want = "value"
        elif p == ",":
            want = "key" if stack[-1] == "{" else "value"
        elif p and p in "}]" and (p == "}") == (stack[-1] == "{"):
            stack.pop()
            yield p, None
        else:
            raise ValueError(f"unexpected token at {pos}")


def triples(text: str, lists: dict[str, str], maps: frozenset[str]) -> list[tuple[str, str, str, str | None]]:
    """``(grp, path, field, value)`` of one record; ValueError for invalid JSON.

    The record's own fields have an empty group and the path ``0``.

    lists: key of a repeated child and the key of a wrapper that may stand around its
    elements; the same keys may repeat at any depth. maps: keys of open key-value
    maps, given as an object, as a list of ``k``/``v`` objects or as encoded text. A
    single object instead of a list has position 1, null elements take a position and
    give nothing, wrappers and encoded texts add no level.
    """
    out: list[tuple[str, str, str, str | None]] = []
    wrappers = frozenset(lists.values())
    # A frame is [kind, grp, path, counter or key, seen]; kinds: rec, list (value of a repeated
    # key), arr (its elements), map, pairs (list of k/v), pair, skip.
    def run(text: str, frame: list) -> None:
        stack = [frame]
        for kind, value in events(text):
            top = stack[-1]
            k, grp, path = top[0], top[1], top[2]
            if kind in "}]":
                stack.pop()
                if k == "rec" and grp and not top[4]:
                    out.append((grp, path, "", None))
                if k == "pair" and "k" in top[4]:
                    out.append((grp, path, top[4]["k"], top[4].get("v")))
                continue
            if kind == "k":
                top[3] = value
                continue
            opens = kind in "{["
            nxt = ["skip", grp, path, None, False]
            # What the new value is to its place; at the start of the text the place is the frame itself.
            place = _place(top, lists, wrappers, maps)
            path = top[2]
            if place[0] == "field":
                if not opens:
                    out.append((grp, path or "0", top[3], value))
                    top[4] = True
            elif place[0] == "list":
                _, g, p = place
                if kind == "{":
                    nxt = ["solo", g, p, None, False]
                elif kind == "[":
                    nxt = ["arr", g, p, 0, False]
                elif kind == "s":
                    nested(value, ["list0", g, p, None, False])
            elif place[0] == "elem":
                _, g, p = place
                if kind == "{":
                    nxt = ["rec", g, p, None, False]
                elif kind == "s":
                    nested(value, ["elem0", g, p, None, False])
                elif kind == "[" and not g:
                    nxt = ["arr", g, p, 0, False]
            elif place[0] == "map":
                _, g, p = place
                if kind == "{":
                    nxt = ["map", g, p, None, False]
                elif kind == "[":
                    nxt = ["pairs", g, p, None, False]
                elif kind == "s":
                    nested(value, ["map0", g, p, None, False])
            elif place[0] == "entry":
                out.append((grp, path, top[3], value))
            elif place[0] == "pairs" and kind == "{":
                nxt = ["pair", grp, path, None, {}]
            elif place[0] == "pair" and kind in "sn":
                top[4].setdefault("k" if top[3] in ("k", "key") else "v" if top[3] in ("v", "value") else "", value)
            if opens:
                stack.append(nxt)

    def nested(text: str, frame: list) -> None:
        mark = len(out)
        try:
            run(text.strip(_AROUND), frame)
        except ValueError:
            del out[mark:]

    run(text.strip(_AROUND), ["elem0", "", "", None, False])
    return out


def _place(top: list, lists: dict[str, str], wrappers: frozenset[str], maps: frozenset[str]) -> tuple:
    kind, grp, path, key = top[:4]
    if kind in ("rec", "solo"):
        if kind == "solo":
            if key in wrappers:
                return ("list", grp, path)
            # No wrapper: the object itself is the only element.
            top[0], top[2] = "rec", f"{path}.1" if path else "1"
            path = top[2]
        if key in lists:
            top[4] = top[4] or False
            return ("list", key, path)
        if key in maps:
            return ("map", key, path or "0")
        if grp and key in wrappers:
            top[4] = True
            return ("elem", grp, path)
        return ("field",)
    if kind == "arr":
        top[3] += 1
        return ("elem", grp, (f"{path}.{top[3]}" if path else str(top[3])) if grp else "")
    if kind == "list0":
        return ("list", grp, path)
    if kind == "elem0":
        return ("elem", grp, path)
    if kind == "map0":
        return ("map", grp, path)
    return {"map": ("entry",), "pairs": ("pairs",), "pair": ("pair",)}.get(kind, ("skip",))


def shred(df: DataFrame, record_id: str, payload: str, lists: dict[str, str], maps: set[str]) -> DataFrame:
    """Triples of all records: ``record_id, grp, path, field, value``.

    A payload that is null, blank or not valid JSON gives no row; blanks and
    byte-order marks around it do no harm. Columns besides the two named ones are
    not read, so clashing names do not matter. Repeated rows give repeated triples.
    """
    maps_ = frozenset(maps)
    schema = pa.schema([("record_id", pa.int64()), ("grp", pa.string()), ("path", pa.string()), ("field", pa.string()), ("value", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for rid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text is None:
                    continue
                try:
                    got = triples(text, lists, maps_)
                except ValueError:
                    continue
                cols[0].extend([rid] * len(got))
                for i in range(4):
                    cols[i + 1].extend([t[i] for t in got])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    src = df.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return src.where("payload is not null").mapInArrow(work, "record_id bigint, grp string, path string, field string, value string")


def pivot_group(t: DataFrame, grp: str, fields: list[str]) -> DataFrame:
    """One flat table of a group: ``record_id, path`` and a column for each field (null where absent)."""
    return t.where(F.col("grp") == grp).groupBy("record_id", "path").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])


def member_item(type_: Column, ref: Column) -> Column:
    """``way/123``; type from the reference's letter where it is missing, ``?`` for a null."""
    letter = F.lower(F.coalesce(F.when(F.trim(type_) != "", F.trim(type_)), F.regexp_extract(ref, r"^\s*([A-Za-z])[A-Za-z]*[/ ]?-?[0-9]+\s*$", 1)))
    kind = (
        F.when(letter.startswith("n"), F.lit("node")).when(letter.startswith("w"), F.lit("way")).when(letter.startswith("r"), F.lit("relation"))
        .when(letter != "", letter).otherwise(F.lit("?"))
    )
    digits = F.regexp_extract(ref, r"(-?[0-9]+)\s*$", 1)
    return F.concat(kind, F.lit("/"), F.when(digits != "", digits).otherwise(F.lit("?")))
