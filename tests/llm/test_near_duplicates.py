"""Near-duplicates and components against all pairs, contamination against plain search."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import decontaminate
from millrace.llm.components import connected_components
from millrace.llm.decontaminate import find_contamination, op5_decontamination, remove_contaminated
from millrace.llm.minhash import Shingler, near_duplicates, op8_minhash
from tests.llm.helpers import SMALL, by_id, contamination, documents, frame, groups, near_duplicates as brute_force, shingles

pick = random.Random(42)


def text_of(n):
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def changed(text, share):
    return " ".join("zz" + w if pick.random() < share else w for w in text.split(" "))


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    backwards = [(300 - i, 299 - i) for i in range(40)]
    star = [(500, 500 + i) for i in range(1, 300)]
    odd = [(900, 900), (901, 902), (902, 901), (901, 902), (160, 259)]
    edges = chain + backwards + star + odd
    got = {r.node: r.component for r in connected_components(frame(spark, edges + [(None, 1)], "a long, b long")).collect()}
    wanted = groups(edges, {n for e in edges for n in e})
    del wanted[900]
    assert got == wanted
    assert connected_components(frame(spark, [], "a long, b long")).count() == 0


def check(spark, rows, **extra):
    got = by_id(near_duplicates(frame(spark, rows)))
    components, sizes = brute_force(dict(rows))
    assert {i: r.component_id for i, r in got.items()} == components
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    return got


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    components, sizes = brute_force(dict(rows))
    got = by_id(op8_minhash(spark, SMALL))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (sizes[i], components[i]) for i, _ in rows}


def test_families_without_a_centre(spark):
    """Copies of a text that is not in the table: each is near some others and far from most, so one star per bucket is not enough."""
    base = text_of(120)
    rows = [(i, changed(base, 0.022)) for i in range(60)]
    step, walk = text_of(80), []
    for i in range(100, 130):  # every text is near the ones before and after it
        walk.append((i, step))
        step = changed(step, 0.02)
    got = check(spark, rows + walk)
    assert 1 < len({r.component_id for r in got.values()}) < 90


def test_awkward_texts(spark):
    words = text_of(300)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (7, "one two three four five"), (8, words), (9, words.upper()),
        (10, words + " more"), (11, "é é é é é é"), (12, "É É É É É É"), (13, "a b c d e f"), (14, "b c d e f g"), (15, "x " * 100_000),
        (16, "x x x x x"), (17, "one two"), (18, "one\x0btwo"),
    ]
    got = check(spark, rows)
    assert got[9].component_id == 8 and got[10].component_id == 8 and got[16].component_id == 15 and got[18].component_id == 4
    assert (got[1].n_shingles, got[1].component_id, got[1].kept) == (0, 1, True)


def test_repeated_and_null_ids(spark):
    a, b = text_of(50), text_of(50)
    rows = [(None, a), (3, a), (3, a), (2, b), (3, b), (9, text_of(50))]
    df = frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, node long")
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in near_duplicates(df).collect() if r.doc_id is not None)
    # the rows with id 3 are one document, which is near 2
    assert got == [(2, 2, True), (3, 2, False), (3, 2, False), (3, 2, False), (9, 9, True)]
    assert near_duplicates(frame(spark, [])).count() == 0


def test_sets_of_one_size_under_a_repeated_id(spark):
    a, b = text_of(50), text_of(50)
    rows = [(3, a), (3, b), (4, a[:-1] + "y"), (5, b[:-1] + "y"), (9, text_of(50))]
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == [(3, 3), (3, 3), (4, 3), (5, 3), (9, 9)]


def test_sketch_estimates_similarity():
    shingler = Shingler(bands=128, rows=1)
    for share in (0.01, 0.05, 0.2):
        base = text_of(600)
        other = changed(base, share)
        a, b = shingles(base), shingles(other)
        true = len(a & b) / len(a | b)
        same = (shingler.buckets(shingler.shingles(base.encode())) == shingler.buckets(shingler.shingles(other.encode()))).mean()
        assert abs(true - same) < 0.2
    assert len(shingler.shingles(b"a b c d")) == 1 and len(shingler.shingles(b"")) == 0


def test_odd_sketches_never_differ_more_than_the_sets():
    shingler = Shingler()
    for n, share in ((20, 0.1), (400, 0.02), (400, 0.3), (9000, 0.05)):
        base = text_of(n)
        a, b = (shingler.shingles(t.encode()) for t in (base, changed(base, share)))
        bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in shingler.odd_sketch(a) ^ shingler.odd_sketch(b))
        apart = len(set(a.tolist()) ^ set(b.tolist()))
        assert bits <= apart and (n > 1000 or bits >= 0.8 * apart)


ITEM = "the quick brown fox jumps over the lazy dog and then sleeps all day long"
ITEMS = [(1, ITEM), (10, "short one here"), (2, None), (3, "..."), (4, "word"), (5, ITEM), (7, ITEM + " " + text_of(60)), (8, "a b")]
DOCS = [
    (1, "Before. " + ITEM.upper() + "! after"), (2, "brown fox jumps over the lazy dog and then sleeps"), (3, "fox jumps over the lazy dog and then sleeps"),
    (4, "a short-one, HERE."), (5, None), (6, ""), (7, "... !!"), (8, "Word"), (9, "wörd"), (10, ITEM + " " + ITEM), (11, "a b a b"),
    (12, "filler words " * 60_000 + ITEM), (13, "the quick brown fox jumps over the lazy"), (14, "dog and then sleeps all day long the quick brown fox"),
]


@pytest.mark.parametrize("options", [{}, {"shard_words": 8}, {"block_bytes": 40}])
def test_contamination_against_plain_search(spark, options):
    df = frame(spark, [(*r, 3) for r in DOCS], "doc_id long, text string, row long")
    items = frame(spark, ITEMS, "item_id long, text string")
    got = by_id(find_contamination(df, items, **options))
    wanted = contamination(dict(DOCS), dict(ITEMS))
    assert {i: (r.n_words, r.n_hit, r["items"]) for i, r in got.items()} == wanted
    assert all(r.contaminated == (wanted[i][1] > 0) and sum(x.end - x.start for x in r.runs) == r.n_hit for i, r in got.items())
    assert (got[1].longest.n_words, got[1].longest.start) == (15, 1)
    clean = {i for i, r in wanted.items() if not r[1]}
    left = remove_contaminated(df, items, **options)
    assert {r.doc_id for r in left.collect()} == clean and left.columns == df.columns


def test_contamination_of_given_documents(spark):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    wanted = contamination({r.doc_id: r.text for r in documents(spark).collect()}, bench)
    for i, r in by_id(op5_decontamination(spark, SMALL)).items():
        n_words, n_hit, items = wanted[i]
        assert (r.n_words, r.n_hit, r.n_items) == (n_words, n_hit, len(items))
        assert r.items_sha256 == hashlib.sha256(",".join(map(str, items)).encode()).hexdigest()


def test_contamination_with_empty_tables_and_repeats(spark):
    items, docs = frame(spark, ITEMS, "item_id long, text string"), frame(spark, DOCS)
    assert find_contamination(docs.filter("false"), items).count() == 0
    assert find_contamination(docs, items.filter("false")).filter("contaminated").count() == 0
    rows = frame(spark, [(None, ITEM), (1, ITEM), (1, ITEM), (1, "clean")])
    assert sorted(r.n_hit for r in find_contamination(rows, items.filter("item_id = 1")).collect()) == [0, 15, 15, 15]
    assert [r.text for r in remove_contaminated(rows, items).collect()] == ["clean"]
    named = frame(spark, [("b", "one two"), ("a", "three four")], "item_id string, text string")
    row = find_contamination(frame(spark, [(1, "one two three four")]), named).first()
    assert row["items"] == ["a", "b"] and row.n_hit == 4


def test_items_without_an_id_hit_words(spark):
    items = frame(spark, [(None, ITEM), (4, "word"), (None, None)], "item_id long, text string")
    docs = frame(spark, [(1, "so " + ITEM), (2, "word and " + ITEM), (3, "clean")])
    for options in ({}, {"block_bytes": 4}):
        got = by_id(find_contamination(docs, items, **options))
        assert {i: (r.n_hit, r["items"], r.contaminated) for i, r in got.items()} == {1: (15, [], True), 2: (16, [4], True), 3: (0, [], False)}
        assert [r.doc_id for r in remove_contaminated(docs, items, **options).collect()] == [3]


def test_more_distinct_words_than_a_key_of_three_can_number(monkeypatch):
    monkeypatch.setattr(decontaminate, "ID_BITS", 3)
    texts = {i: t for i, t in DOCS if i != 12} | {20: text_of(40), 21: "short one over here"}
    bench = {i: t for i, t in ITEMS} | {30: "one over", 31: "dog and then"}
    vocabulary, parts = {b"": 0}, []
    for text in texts.values():
        parts.append([vocabulary.setdefault(w, len(vocabulary)) for w in [*decontaminate.words((text or "").encode()), b""]])
    tokens, starts = np.array(sum(parts, []), np.int32), np.cumsum([0, *map(len, parts)])[:-1]
    queries = decontaminate.Queries([(i, t.encode()) for i, t in bench.items() if t], decontaminate.WINDOW)
    hits = decontaminate.search_shard(tokens, starts, decontaminate.SuffixArray(tokens, vocabulary, queries.depth), queries)
    wanted = contamination(texts, bench)
    for k, i in enumerate(texts):
        own = hits.get(k, {"runs": [], "items": []})
        assert (sum(b - a for a, b in own["runs"]), sorted(own["items"], key=str)) == wanted[i][1:]


def test_all_documents_of_a_larger_table_against_all_pairs(spark):
    larger = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, larger).collect()}
    components, sizes = brute_force(texts)
    got = by_id(op8_minhash(spark, larger))
    assert {i: (r.component_id, r.n_shingles) for i, r in got.items()} == {i: (components[i], sizes[i]) for i in texts}
