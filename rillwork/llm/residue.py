"""Template residue, filler, error pages and script notices.

A naive Bayes model over words is fitted by expectation-maximization from positive and
unlabelled records. Positive are trusted records: those mostly made of the seed phrases
(error messages, filler, script notices) with all their passages, and those with several
open template fields with these fields. All others start as unlabelled and get their own
probabilities. Passages of a record are its lines and, cut out of them, its template
fields; every passage is scored. A record is a case when one of its fields is positive
(one left-over field is enough), or when passages with most of its words, a title above
them aside, are. Fields in quotation marks are talk about fields: they have words of their
own in the model, and the fit takes them as negative. Pages
with delimiters are read down their columns, so that a field broken at a line end is whole.

The fit takes bounded, hash-chosen samples of each kind (FIT_TRUSTED, FIT_UNLABELLED) with
a bounded number of passages and words of each (FIT_PASSAGES, FIT_WORDS), in one task; the
driver gets the log odds of the words alone. The scores and decisions cover every record whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm import pages
from rillwork.runtime import materialize

#: Records of each kind in the fit's sample, passages of such a record and words of such a passage.
FIT_TRUSTED = 3000
FIT_UNLABELLED = 3000
FIT_PASSAGES, FIT_WORDS = 64, 48
EM_STEPS = 6
#: Log odds of a word that the fit has not seen.
UNSEEN = -0.7
#: Share of a record's words in positive passages, its title aside, that makes it a case.
SHARE = 0.5
#: Log odds of a passage or word count at most this much, and a record has to reach MARGIN.
CLIP, MARGIN = 8.0, 1.0
#: Lines above the first positive one that may be the title.
TITLE_LINES = 2

# Phrases that trusted records are made of, in lower case.
SEEDS = (
    "lorem", "ipsum", "javascript", "scripts are", "allow scripts", "requires scripts", "скрипты", "скриптов", "поддержки сценариев", "skripte ", "les scripts",
    "error 4", "error 5", "ошибка 4", "ошибка 5", "erreur 4", "erreur 5", "fehler 4", "fehler 5", "not found", "не найден", "introuvable", "nicht gefunden",
    "access denied", "доступ запрещ", "zugriff verweigert", "accès refus", "too many requests", "page reader, line", "traceback", "dummy text", "blindtext", "faux texte",
    "рыба, рыба", "text goes here", "будет текст", "hier steht später", "text folgt", "platzhalter für", "placeholder", "sample paragraph",
    "xxx xxx", "asdf asdf", "qwer qwer", "фыва фыва", "йцук йцук", "bla bla", "test test", "abc abc", "тест тест",
)

# Fields that stand for a trusted placeholder record where a corpus has none.
SEED_FIELDS = (
    "{{title}} {{ title }} {{{title}}} {{page.title|upper}} {title} ${title} #{title} {% title %} <%= title %> [[title]] [[ title ]] <<title>> %(title)s %title% $title$ "
    "@@title@@ __title__ &lt;title&gt; [insert headline] <insert headline> {insert headline} [your text here] <your text here> [name] <name> [date] <date>"
)

_DOUBLE = r"\{\{|\}\}|\{%|%\}|<%|%>|\[\[|\]\]|<<|>>|\$\{|#\{|@@|%\(\w"
_SINGLE = (
    r"\{[^\W\d_][\w .'’|-]+\}|\[[^\W\d_][^\[\]{}<>]{2,}\]|<[^\W\d_][^<>\[\]{}]{2,}>"
    r"|&[\w|]{1,3};[^&;]{2,}&[\w|]{1,3};|%[^\W\d_]\w{2,}%|\$[^\W\d_]\w{2,}\$|(?<!\w)__[^\W_]\w+?__(?!\w)"
)
_NUMBER = re.compile(r"(?<!\S)(?=\S*?[0-9])\S+")
_FIELD = re.compile(f"{_DOUBLE}|{_SINGLE}")
_DELIM = re.compile(r"[{}\[\]<>%$#@&]|__")
_NAME = re.compile(r"[^\n{}\[\]<>%$#@&]{0,30}")
_CLOSE = re.compile(r"[\"'«»“”„‟‘’‚‹›`]")
_QUOTED = re.compile(r"[\"'«»“”„‟‘’‚‹›`]\s*[\[{<%$#@_&(]*$")


#: Set before the words of a field, in quotation marks or not.
QUOTED, OPEN = "\x02", "\x03"


def fields(text: str) -> list[list[str]]:
    """Words of each template field: its delimiters as one word, then the folded words behind; all marked as a field's, quoted or not."""
    if _DELIM.search(text) is None:
        return []
    flat = re.sub(r"[-­¬=~‐–]?\s*\n\s*", " ", text) if "\n" in text else text
    out = []
    seen = 0  # end of the last quoted field
    for m in _FIELD.finditer(flat):
        if m.start() < seen:
            continue
        body = m.group()
        name = _NAME.match(flat, m.end()).group() if len(body) <= 3 else body
        ws = ["\x01" + re.sub(r"[\w\s.'’|-]+", "_", body), *pages.fold(name.replace("_", " ")).split()[:2]]
        if _QUOTED.search(flat[max(0, m.start() - 6) : m.start()]):
            close = _CLOSE.search(flat, m.end())
            seen = close.end() if close and close.start() - m.end() < 60 else m.end()
            out.append([QUOTED + w for w in ws])
        else:
            out.append([OPEN + w for w in ws])
    return out


def read_down(text: str, xs: list[int], ys: list[int]) -> str:
    """The text column by column where it has delimiters of fields, else as it is."""
    if _DELIM.search(text) is None:
        return text
    return "\n".join("\n".join(c) for c in pages.columns(text, xs, ys))


def open_field(text: str) -> bool:
    """Has the text a template field that isn't quoted?"""
    return any(ws[0][0] != QUOTED for ws in fields(text))


def has_seed(text: str) -> bool:
    return any(map(text.lower().__contains__, SEEDS))


UNLABELLED, TRUSTED, PLACEHOLDER = range(3)


def kind_of(text: str) -> int:
    """TRUSTED: at least half of the lines, or three of them, hold seed phrases; PLACEHOLDER: two open fields or more."""
    if has_seed(text):
        lines = [s for s in text.split("\n") if s.strip()]
        hits = sum(map(has_seed, lines))
        if hits * 2 >= len(lines) > 0 or hits >= 3:
            return TRUSTED
    return PLACEHOLDER if sum(ws[0][0] != QUOTED for ws in fields(text)) > 1 else UNLABELLED


def fit_passages(kind: int, text: str) -> tuple[list[str], list[bool]]:
    """At most FIT_PASSAGES lines and fields of a record, each of at most FIT_WORDS words set apart by blanks, evenly taken."""
    # The other text of a record with placeholders is neither.
    lines = _passages(text) if kind != PLACEHOLDER else []
    out, is_field = [], []
    for rows, f in ((lines, False), (fields(text), True)):
        every = -(-len(rows) // FIT_PASSAGES) or 1
        for ws in rows[::every]:
            out.append(" ".join(ws[:FIT_WORDS]))
            is_field.append(f)
    return out, is_field


def _passages(text: str) -> list[list[str]]:
    """Folded words of each line; numbers are left out."""
    return [ws for line in pages.fold(_NUMBER.sub(" ", text)).split("\n") if (ws := line.split())]


def _body(scores: list[float]) -> int:
    """Number of title lines to leave out: lines that don't look positive above one that does."""
    skip = 0
    while skip < min(TITLE_LINES, len(scores) - 1) and scores[skip] <= 0:
        skip += 1
    return skip


class Model:
    """Log odds of words; fitted by PU expectation-maximization on passages and records."""

    def __init__(self, odds: dict[str, float]) -> None:
        self.odds = odds

    @staticmethod
    def fit(records: list[tuple[int, list[str], list[bool]]]) -> "Model":
        """records: kind, passages and which of them are fields (of :func:`fit_passages`)."""
        vocab: dict[str, int] = {}
        flat: list[int] = []
        row: list[int] = []  # passage of each word
        record: list[int] = []  # record of each passage
        is_field: list[bool] = []
        records = sorted([*records, (PLACEHOLDER, *fit_passages(PLACEHOLDER, SEED_FIELDS))], key=lambda r: r[0])
        for r, (_, passages, are_fields) in enumerate(records):
            for ws, f in zip(passages, are_fields):
                ids = [vocab.setdefault(w, len(vocab)) for w in ws.split(" ")]
                flat.extend(ids)
                row.extend([len(record)] * len(ids))
                record.append(r)
                is_field.append(f)
        w, row_, rec, field, v = np.array(flat), np.array(row), np.array(record), np.array(is_field), len(vocab)
        n_rec = len(records)
        label = np.array([k in (TRUSTED, PLACEHOLDER) for k, _, _ in records])
        fixed = label[rec]
        # Quoted fields are known negatives.
        quoted = np.array([x[0] == QUOTED for x in vocab], bool)
        talk = np.zeros(len(rec), bool)
        talk[row_[quoted[w]]] = True
        fixed = fixed | talk
        p = np.where(talk, 0.0, fixed)
        order = np.flatnonzero(~field)  # lines, in the order of their records
        n_lines = np.bincount(rec[order], minlength=n_rec)
        first = np.concatenate([[0], np.cumsum(n_lines)[:-1]])
        odds, n = np.zeros(v), np.bincount(w, minlength=v)
        logit = lambda x: float(np.log(x / (1 - x)))
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
        for _ in range(EM_STEPS):
            q = p[row_]
            a, b = np.bincount(w, q, v), np.bincount(w, 1 - q, v)
            odds = np.clip(np.log((a + 0.05) / (a.sum() + 0.05 * v)) - np.log((b + 0.05) / (b.sum() + 0.05 * v)), -CLIP, CLIP)
            odds = np.where(quoted, np.minimum(odds, UNSEEN), odds)
            odds = np.where(n < 2, np.minimum(odds, 0.5), odds)
            score = np.clip(np.bincount(row_, odds[w], len(rec)), -CLIP, CLIP)
            # Lines get the probability of their record, whose title doesn't count against it.
            line = score[order]
            keep = np.ones(len(line))
            above = np.ones(n_rec, bool)
            for k in range(TITLE_LINES):
                r = np.flatnonzero(above & (n_lines > k + 1))
                r = r[line[first[r] + k] <= 0]
                keep[first[r] + k] = 0
                above = np.isin(np.arange(n_rec), r)
            total = np.bincount(rec[order], line * keep, n_rec)
            whole = p[order][~fixed[order]]
            rate = float(np.clip(whole.mean() if len(whole) else 0.5, 1e-3, 0.5))
            post = sigmoid(total + logit(rate))
            # Fields have their own.
            loose = field & ~fixed
            f_rate = float(np.clip(p[loose].mean(), 0.05, 0.5)) if loose.any() else 0.5
            p = np.where(fixed, np.where(talk, 0.0, 1.0), np.where(field, sigmoid(score + logit(f_rate)), post[rec]))
        return Model(dict(zip(vocab, odds.tolist())))

    def case(self, text: str) -> bool:
        """Has the record a positive field, or does it consist of positive passages, its title aside?"""
        get = self.odds.get
        if any(sum([get(w, UNSEEN) for w in ws]) > 0 for ws in fields(text)):
            return True
        rows = _passages(text)
        if not rows:
            return False
        scores = [max(-CLIP, min(CLIP, sum([get(w, UNSEEN) for w in ws]))) for ws in rows]
        skip = _body(scores)
        good = sum(len(ws) for ws, x in zip(rows[skip:], scores[skip:]) if x > 0)
        return sum(scores[skip:]) > MARGIN and good >= SHARE * sum(map(len, rows[skip:]))


def residue_pages(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of records with an open template field, or that consist of filler, errors or script notices.

    Null, empty and blank texts are no case. Long texts are read whole, repeated ids give
    one row. ``lines`` (boxes with x and y, one for each line of the text), where there is
    such a column, gives the columns of a page; other columns are not read.
    """
    spark = docs.sparkSession
    none = F.lit(None).cast("array<struct<x:int,y:int>>")
    box = F.transform("lines", lambda l: F.struct(F.coalesce(l["x"], F.lit(0)).alias("x"), F.coalesce(l["y"], F.lit(0)).alias("y"))) if "lines" in docs.columns else none
    src = docs.select(F.col(id_).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), box.alias("lines")).where("doc_id is not null and length(trim(text)) > 0")

    # Only records below a hash cut enter, so that what all tasks hold together is bounded too.
    total = max(1, docs.count())
    bound = {UNLABELLED: FIT_UNLABELLED, TRUSTED: FIT_TRUSTED, PLACEHOLDER: FIT_TRUSTED}
    cut = {k: (4 if k == UNLABELLED else 200) * n / total * 2**32 for k, n in bound.items()}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The records of each kind with the smallest hashes of each task.
        import heapq
        import zlib

        keep: dict[int, list] = {k: [] for k in bound}
        for b in batches:
            for i, t, x, y in pages.read(b):
                h = zlib.crc32(str(i).encode())
                if h >= cut[TRUSTED] or (h >= cut[UNLABELLED] and not has_seed(t) and _DELIM.search(t) is None):
                    continue
                t = read_down(t, x, y)
                kind = kind_of(t)
                heap = keep[kind]
                if h < cut[kind] and (len(heap) < bound[kind] or -heap[0][0] > h):
                    (heapq.heappush if len(heap) < bound[kind] else heapq.heapreplace)(heap, (-h, i, *fit_passages(kind, t)))
        rows = [(k, -h, p, f) for k, heap in keep.items() for h, _, p, f in heap]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3] for r in rows], pa.list_(pa.bool_()))], names=["kind", "h", "passages", "fields"])

    sample = materialize(src.mapInArrow(mark, "kind int, h bigint, passages array<string>, fields array<boolean>"), "fit-sample")
    chosen = None
    for k, n in bound.items():
        part = sample.where(F.col("kind") == k).orderBy("h", "passages").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("kind", "ascending"), ("h", "ascending")])
        odds = Model.fit(list(zip(*[rows.column(c).to_pylist() for c in ("kind", "passages", "fields")]))).odds
        return pa.table({"word": pa.array(list(odds), pa.string()), "odds": pa.array(list(odds.values()), pa.float64())})

    # One task has the whole sample, of bounded records, passages and words.
    odds = spark.sparkContext.broadcast({r.word: r.odds for r in chosen.withColumn("part", F.lit(1)).groupBy("part").applyInArrow(learn, "word string, odds double").collect()})

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(odds.value)
        for b in batches:
            ids = [i for i, t, x, y in pages.read(b) if m.case(read_down(t, x, y))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], names=["doc_id"])

    return src.mapInArrow(decide, "doc_id bigint").distinct().withColumnRenamed("doc_id", id_)
