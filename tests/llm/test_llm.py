"""The llm operators against brute force, exact references and hostile small inputs."""

import itertools
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rillwork.llm import bpe, components, leaks, matching, pages, residue
from rillwork.llm import queries as q


def brute_groups(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(("a", a))] = find(("b", b))
    least = {}
    for _, b in pairs:
        least[find(("b", b))] = min(b, least.get(find(("b", b)), b))
    return {(a, least[find(("a", a))]) for a, _ in pairs}


def test_p6_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/graph_nodes_stat.parquet").select("pnt_osm_id", "way_osm_id").collect()
    expect = brute_groups([(a, b) for a, b in rows if a is not None and b is not None])
    got = [tuple(r) for r in q.p6_found(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == expect


def test_groups_long_chain_and_hub(spark):
    rnd = random.Random(3)
    pairs = [(i, i) for i in range(400)] + [(i, i + 1) for i in range(400)] + [(5000 + i, -77) for i in range(9000)] + [(9500, 600), (9500, 601)]
    rnd.shuffle(pairs)
    df = spark.createDataFrame([(a, b, 1) for a, b in pairs * 2] + [(None, 3, 1), (3, None, 1)], "n long, w long, v int")
    assert {tuple(r) for r in components.link_groups(df, "n", "w").collect()} == brute_groups(pairs)
    assert components.link_groups(df.limit(0), "n", "w").count() == 0


def test_groups_of_any_ids(spark):
    big = 1 << 62
    pairs = [(1, big), (1 + (1 << 61), big + 1), (1 + (1 << 60), -big), (-(1 << 63), (1 << 63) - 1), (big, (1 << 63) - 1)]
    df = spark.createDataFrame(pairs, "n long, w long")
    assert {tuple(r) for r in components.link_groups(df, "n", "w").collect()} == brute_groups(pairs)
    edges = spark.createDataFrame([(1, 2), (2, 3), (big, 3), (7, 7), (None, 1)], "u long, v long")
    labels = spark.createDataFrame([(3, 30), (2, 20), (9, 90), (7, 70)], "v long, label long")
    assert {tuple(r) for r in components.components(edges, labels).collect()} == {(1, 20), (2, 20), (3, 20), (big, 20), (7, 70), (9, 90)}


def test_growth_refers_once_to_each_step(spark):
    def leaves(rounds):
        components.ROUNDS, kept = rounds, components.ROUNDS
        seen = []
        write, components.materialize = components.materialize, lambda df, name="step": (seen.append((name, df)), write(df, name))[1]
        try:
            components.link_groups(spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "n long, w long"), "n", "w").count()
        finally:
            components.ROUNDS, components.materialize = kept, write
        plan = next(df for name, df in seen if name == "assign")._jdf.queryExecution().optimizedPlan()
        return plan.collectLeaves().size()

    two, three, four = (leaves(n) for n in (2, 3, 4))
    assert four - three == three - two <= 4  # the plan grows by the same few leaves with each step


TEXTS = ["", None, " ", "  a\n\n\n b   c  ", "<|endoftext|> aaaaaaaaa bbbb", "don't We'LL 'tis ½²③", "\x1c\x1d x​ y　z", "é́ 日本語 \U0001f937\U0001f3fd‍♀️", "Привет, мир-мир!" * 3, "aaa" * 5000, "x" * 40000]


def test_p7_round_trip(spark):
    from tokenizers import Tokenizer

    if not os.path.exists(bpe.DEFAULT_VOCABULARY):
        pytest.skip("no vocabulary")
    t = Tokenizer.from_file(bpe.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS)] + [(None, "null id", "clash"), (3, TEXTS[3], "again")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, list(r.ids)) for r in bpe.encode(df, "doc_id", "text").collect())
    expect = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in [*enumerate(TEXTS), (-1, "null id"), (3, TEXTS[3])]]
    assert got == sorted(expect)
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def test_p7_whole_corpus(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = q.p7_ids(spark, sf).collect()
    assert len(got) == len(texts) and all(t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids == list(r.ids) for r in got)


def test_reading_order_and_words():
    text = "The har-\nleft col\nbour was\nright col"
    assert pages.columns(text, [10, 400, 12, 398], [0, 0, 30, 30]) == [["The har-", "bour was"], ["left col", "right col"]]
    assert pages.columns("a one    b one\na two   b two\nb tail", [5, 5, 300], [0, 10, 20]) == [["a one", "a two"], ["b one", "b two", "b tail"]]
    assert pages.words([["The har-", "bour inspe", "ctor w4s"]], {"lhspector", "inspector", pages.fold("inspector")}) == [pages.fold(w) for w in ("the", "harbour", "inspector", "w4s")]
    assert pages.fold("Fuß, Ünder—ſtrïcken Рeкa") == pages.fold("FUSS UNDER STRICKEN река").replace(pages.fold("under stricken"), pages.fold("understricken"))


def leak_rows():
    rnd = random.Random(9)
    vocab = ["".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5))) for _ in range(500)]
    said = "Read the passage below with care and choose the best answer to it now please."
    items = [(k, said + " " + " ".join(rnd.choice(vocab) for _ in range(60))) for k in range(12)]
    filler = lambda n: [rnd.choice(vocab) for _ in range(n)]

    def page(words):
        lines = [" ".join(words[i : i + 6]) for i in range(0, len(words), 6)]
        return "\n".join(lines), [Row(x=5, y=20 * i, w=1, h=1, conf=1.0) for i in range(len(lines))]

    docs, expect = [], set()
    for d in range(200):
        words = filler(60)
        k = d % 12
        own = items[k][1].split()[15:]
        if d < 40:
            s = rnd.randrange(0, 40)
            part = own[s : s + 12 + d % 7]
            if d % 3 == 0:
                part[5] = part[5][:-1] + "q"
            if d % 4 == 0:
                part[6:6] = "WANTED a good pony apply to the miller at the quay".split()
            words[30:30] = part
            expect.add((d, k))
        elif d < 60:
            words[30:30] = own[:8]
        elif d < 80:
            words[30:30] = said.split()
        elif d < 100:
            mixed = own[:20]
            rnd.shuffle(mixed)
            words[30:30] = mixed
        docs.append((d, *page(words)))
    return docs, items, expect


def test_p8_planted(spark):
    docs, items, expect = leak_rows()
    box = "array<struct<x:int,y:int,w:int,h:int,conf:double>>"
    extra = [(900, None, None), (901, "", []), (902, docs[0][1], None)]
    df = spark.createDataFrame(docs + extra + docs[:3], f"doc_id long, text string, lines {box}")
    it = spark.createDataFrame(items + [(77, None), (78, "short one")], "item_id long, text string")
    got = [tuple(r) for r in leaks.find_leaks(df, it).collect()]
    assert len(got) == len(set(got)) and set(got) == expect | {(902, 0)}
    assert leaks.find_leaks(df.limit(0), it).count() == 0
    assert leaks.find_leaks(df, it.limit(0)).count() == 0


BOX = "array<struct<x:int,y:int,w:int,h:int,conf:double>>"


def test_p8_common_passages_and_small_corpora(spark):
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5))) for _ in range(500)]
    item = [rnd.choice(vocab) for _ in range(60)]
    it = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(rnd.choice(vocab) for _ in range(40)))], "item_id long, text string")
    # (pages, one in how many has the passage, its words)
    for n, every, k in ((3, 3, 12), (1000, 3, 12), (100, 2, 20), (3, 1, 12)):
        docs = []
        for d in range(n):
            words = [rnd.choice(vocab) for _ in range(40)]
            if d % every == 0:
                words[20:20] = item[8 : 8 + k]
            docs.append((d, " ".join(words), None))
        df = spark.createDataFrame(docs, f"doc_id long, text string, lines {BOX}")
        assert {tuple(r) for r in leaks.find_leaks(df, it).collect()} == {(d, 1) for d in range(0, n, every)}
    whole = spark.createDataFrame([(7, " ".join(item), None)], f"doc_id long, text string, lines {BOX}")
    assert [tuple(r) for r in leaks.find_leaks(whole, it).collect()] == [(7, 1)]


def test_p8_adverts_between_words(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randrange(3, 6)))
    item = [word() for _ in range(60)]
    it = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(word() for _ in range(40)))], "item_id long, text string")
    advert = lambda n: [word() for _ in range(n)]
    cut = [(2, 40), (3, 60), (6, 30), (10, 40), (9, 120), (6, 200)]
    docs = [(d, " ".join(advert(10) + item[20 : 20 + a] + advert(n) + item[20 + a : 32] + advert(10)), None) for d, (a, n) in enumerate(cut)]
    docs.append((100, " ".join(advert(10) + item[20:31] + advert(10)), None))
    df = spark.createDataFrame(docs, f"doc_id long, text string, lines {BOX}")
    assert {tuple(r) for r in leaks.find_leaks(df, it).collect()} == {(d, 1) for d in range(len(cut))}


def test_index_lists(spark):
    df = spark.createDataFrame([(5, "b a b\nc", None), (6, "a", None), (7, "", None), (None, "a", None)], f"doc_id long, text string, lines {BOX}").coalesce(1)
    rows = {r.term: r for r in leaks.build_index(df).collect()}
    assert list(rows[""].docs) == [5, 6] and list(rows[""].at) == [leaks.GUARD, 2 * leaks.GUARD + 4]
    assert {t: (r.n, list(np.cumsum(r.at))) for t, r in rows.items() if t} == {"b": (2, [8, 10]), "a": (2, [9, 20]), "c": (1, [11])}


def test_blocks_and_shards_change_nothing(spark, monkeypatch):
    docs, items, expect = leak_rows()
    df = spark.createDataFrame(docs, f"doc_id long, text string, lines {BOX}")
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 500)
    monkeypatch.setattr(leaks, "SHARD_PHRASES", 100)
    assert {tuple(r) for r in leaks.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()} == expect


def test_workers_need_no_package(tmp_path):
    """Functions and broadcasts reach workers that can't import the package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from rillwork.runtime import session
from rillwork.llm import queries as q
s = session("local[2]", 2, **{{"spark.checkpoint.dir": {str(tmp_path / "ck")!r}}})
print("rows", q.p8_found(s, "/root/testdata/sf0.001").count() > 0, q.p9_found(s, "/root/testdata/sf0.001").count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows True True" in got.stdout, got.stderr[-2000:]


def test_edit_distance():
    def slow(a, b):
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        t[:, 0], t[0] = range(len(a) + 1), range(len(b) + 1)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1, j + 1] = min(t[i, j + 1] + 1, t[i + 1, j] + 1, t[i, j] + (a[i] != b[j]))
        return t[-1, -1]

    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(7))) for _ in "12")
        assert min(leaks.distance(a, b, 3), 4) == min(slow(a, b), 4)


@pytest.mark.parametrize("text,open_", [
    ("A quiet page\n{{headline}} follows", True), ("Courier [INSERT\nHEADLINE] here", True), ("vessel ${price} and", True), ("the %(body)s was", True), ("&lt;title&gt;", True),
    ("The compositor had set “{{headline}}” in the proof", False), ("«{{заголовок}}», и читатели", False), ("« {{titre}} » dans l'épreuve", False), ("„{{titel}}“ im Abzug", False),
    ("Name ........ Street ........", False), ("paid $5 & 3% [1] <3", False), ("“{{a}}” was read\nbut {{b}} stayed", True),
])
def test_open_field(text, open_):
    assert residue.open_field(text) == open_


def test_p9_model_rejects_quoted_fields(spark):
    rnd = random.Random(6)
    words = [a + b + c for a in ("har", "ves", "qua", "mil", "mar") for b in ("bo", "se", "ru", "ti") for c in ("l", "ket", "dge", "ntern")]
    line = lambda: " ".join(rnd.choice(words) for _ in range(6))
    page = lambda mid: "\n".join([*[line() for _ in range(6)], f"{rnd.choice(words)} {mid} {rnd.choice(words)}", line()])
    rows = [(i, page("the compositor had it in the proof" if i % 3 else line())) for i in range(200)]
    rows += [(1000 + i, page("{{headline}} by ${author} stayed")) for i in range(20)]
    rows += [(2000 + i, page("“{{headline}}” in the proof")) for i in range(5)]
    rows += [(3000 + i, page(x)) for i, x in enumerate(("he wrote «${author}» there", "a list [1] and {2} and <3", "paid $5 or 7% & more #4"))]
    rows += [(4000, page("one {{title}} was left")), (4001, page("“{{headline}}” was read but {{headline}} stayed"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in residue.residue_pages(df).collect()} == {1000 + i for i in range(20)} | {4000, 4001}


def test_p9_planted(spark):
    rnd = random.Random(2)
    words = ["harbour", "vessel", "quay", "miller", "market", "bridge", "lantern", "council", "raft", "meadow"]
    normal = [(i, "\n".join(" ".join(rnd.choice(words) for _ in range(6)) for _ in range(8))) for i in range(300)]
    errors = [(1000 + i, "\n".join(rnd.choice(["404 Not Found", "Access denied", "Please enable JavaScript to view this page", "Try again in a while", "Back to the list of issues"]) for _ in range(4))) for i in range(60)]
    title = [(2000, "Harbour Courier\nAccess denied\n404 Not Found\nBack to the list of issues")]
    spoke = [(2001, normal[0][1] + "\nThe clerk said access denied\n" + normal[1][1])]
    none = [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "x" * 200_000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in normal + errors + errors[:5] + title + spoke + none], "doc_id long, text string, trusted int")
    got = [r.doc_id for r in residue.residue_pages(df).collect()]
    assert len(got) == len(set(got)) and set(got) == {i for i, _ in errors} | {2000}
    assert residue.residue_pages(df.limit(0)).count() == 0


def test_p9_field_broken_between_columns(spark):
    rnd = random.Random(5)
    words = ["harbour", "vessel", "quay", "miller", "market", "bridge", "lantern", "council", "raft", "meadow"]
    line = lambda: " ".join(rnd.choice(words) for _ in range(6))
    rows = [(i, "\n".join(line() for _ in range(8)), None) for i in range(300)]
    rows += [(1000 + i, line() + "\nthe [INSERT HEADLINE] and ${title} stayed\n" + line(), None) for i in range(20)]
    # Two columns mixed line by line: the field's halves are apart in the text.
    left, right = [line(), "by the quay [INSERT", "HEADLINE] was read", line()], [line() for _ in range(4)]
    text = "\n".join(s for pair in zip(left, right) for s in pair)
    rows.append((2000, text, [Row(x=10 + 500 * (k % 2), y=30 * (k // 2)) for k in range(8)]))
    df = spark.createDataFrame(rows, "doc_id long, text string, lines array<struct<x:int,y:int>>")
    assert {r.doc_id for r in residue.residue_pages(df).collect()} == {1000 + i for i in range(20)} | {2000}
    assert residue.open_field("the [INSERT A HEADLINE OF AT MOST SIX WORDS FOR THIS STORY HERE] stayed")


def best_total(edges):
    ls = sorted({x for x, _ in edges})
    best = 0.0

    def go(i, used, total):
        nonlocal best
        best = max(best, total)
        if i < len(ls):
            go(i + 1, used, total)
            for (x, r), c in edges.items():
                if x == ls[i] and r not in used:
                    go(i + 1, used | {r}, total + c)

    go(0, frozenset(), 0.0)
    return best


def contested(rnd):
    edges = {(f"l{g}_{i}", f"r{g}_{j}"): rnd.randrange(50, 100) / 100 for g in range(4) for i in range(4) for j in range(4) if rnd.random() < 0.6}
    return edges | {("lone", "r"): 0.7, ("tie1", "t"): 0.8, ("tie2", "t"): 0.8} | {(f"s{i}", f"t{j}"): 0.9 for i in range(4) for j in range(3)}


def test_assignment_is_optimal(spark, monkeypatch):
    edges = contested(random.Random(4))
    df = spark.createDataFrame([(a, b, c) for (a, b), c in edges.items()] * 2, "l string, r string, confidence double")
    got = matching.assign(df).collect()
    assert len({r.l for r in got}) == len(got) == len({r.r for r in got}) and all(edges[r.l, r.r] == r.confidence for r in got)
    groups = [{k: c for k, c in edges.items() if k[0].startswith(p)} for p in ("l0", "l1", "l2", "l3", "lone", "tie", "s")]
    assert abs(sum(r.confidence for r in got) - sum(map(best_total, groups))) < 1e-9
    assert matching.assign(df.limit(0)).count() == 0
    monkeypatch.setattr(matching, "SOLVE_EDGES", 16)  # group by group
    assert abs(sum(r.confidence for r in matching.assign(df).collect()) - sum(map(best_total, groups))) < 1e-9


def test_auction_of_large_groups(spark, monkeypatch):
    rnd = random.Random(5)
    edges = {(f"l{i}", f"r{j}"): rnd.randrange(500, 1000) / 1000 for i in range(4) for j in range(4) if rnd.random() < 0.8}
    monkeypatch.setattr(matching, "SOLVE_EDGES", 0)
    got = matching.assign(spark.createDataFrame([(a, b, c) for (a, b), c in edges.items()], "l string, r string, confidence double")).collect()
    assert abs(sum(r.confidence for r in got) - best_total(edges)) < 1e-3


def test_best_total_equals_brute_force():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        n = int(rnd.integers(1, 5))
        m = int(rnd.integers(n, 6))
        gain = np.round(rnd.random((n, m)) * (rnd.random((n, m)) < 0.7), 1)
        pick = matching.best_total(gain)
        assert len(set(pick.tolist())) == n
        assert abs(gain[np.arange(n), pick].sum() - max(sum(gain[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))) < 1e-9


def test_assignment_takes_a_slightly_better_late_bidder(spark):
    edges = [("a", "r1", 0.80), ("b", "r2", 0.90), ("b", "r1", 0.81), ("c", "r2", 0.95)]
    got = matching.assign(spark.createDataFrame(edges, "l string, r string, confidence double")).collect()
    assert {(r.l, r.r) for r in got} == {("b", "r1"), ("c", "r2")}


def test_names_sound_alike(spark):
    pairs = [("Верхняя Шуместь", "Verkhnyaya Shumest"), ("Ёлгюган (приток озера)", "река Ёлгюган"), ("Юртомка", "Yurtomka River"), ("Вышкаха", "Вышккаха")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(matching.sound(F.col("a")).alias("a"), matching.sound(F.col("b")).alias("b")).collect()
    assert all(r.a == r.b and r.a for r in rows)


def test_p4_planted(spark):
    ps = "struct<x:long,y:long>"
    names = ["Умбра", "Лентра", "Косога", "Вирта", "Полеша", "Гдовка", "Чемра", "Яхрома"]
    w, rel, ways = [], [], []
    for i, n in enumerate(names):
        x = 600_000_000 + i * 900_000
        w.append((f"Q{i}", n, None, Row(x=x, y=400_000_000), Row(x=x + 50_000, y=400_050_000), None))
        rel.append((100 + i, {"name": "река " + n, "type": "waterway"}, [Row(type="way", ref=1000 + i, role=""), None]))
        ways.append((1000 + i, [Row(x=x + 900, y=400_000_500), Row(x=x + 50_300, y=400_049_000)]))
    w += [w[0], ("Q50", "Дальняя", None, Row(x=1, y=1), None, None), ("Q51", None, None, None, None, None), ("Q52", "Связана", None, None, None, 107)]
    rel += [(200, None, None), (201, {"name": "Дальняя"}, [])]
    df = spark.createDataFrame(w, f"id string, name_ru string, name_en string, source_pnt {ps}, mouth_pnt {ps}, osm_id long")
    r = spark.createDataFrame(rel + rel[:2], "rel_osm_id long, tags map<string,string>, members array<struct<type:string,ref:long,role:string>>")
    y = spark.createDataFrame(ways + [(1, None), (None, None)], f"way_osm_id long, geom array<{ps}>")
    got = {(x.id, x.rel_osm_id) for x in matching.match_watercourses(df, r, y).collect()}
    assert got == {(f"Q{i}", 100 + i) for i in range(7)}
    assert matching.match_watercourses(df.limit(0), r, y).count() == 0


def test_p4_known_links(spark):
    """Held-out measure: watercourses with a known relation are matched without looking at it."""
    d = "/root/testdata/sf0.01"
    t = {n: spark.read.parquet(f"{d}/{n}.parquet") for n in ("fin_wikidata_waterways_ru", "osm_relations", "osm_ways")}
    got = {(r.id, r.rel_osm_id) for r in matching.match_watercourses(*t.values(), linked=True).collect()}
    rels = {r[0] for r in t["osm_relations"].select("rel_osm_id").collect()}
    truth = {(r.id, r.osm_id) for r in t["fin_wikidata_waterways_ru"].where("osm_id is not null").select("id", "osm_id").collect() if r.osm_id in rels}
    assert len(got & truth) >= 0.95 * len(got) and len(got & truth) >= 0.9 * len(truth)
