"""Exact duplicates, shards and repeated lines against plain Python."""

import zlib
from collections import Counter

import pytest

from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.line_dedup import drop_emptied, remove_repeated_lines
from millrace.llm.sharding import byte_shards, op4_byte_shards
from tests.llm.helpers import SMALL, by_id, documents, frame, lower_ascii, remove_lines, sha

LONG = "word " * 200_000
TEXTS = [
    (1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, None), (4, ""), (5, LONG), (6, LONG.upper()), (7, "Éa"), (8, "éa"),
    (10, "same texT!"), (11, "x" * 300 + "a"), (12, "x" * 300 + "b"),
]


def test_exact_groups_keep_the_largest_id(spark):
    got = by_id(exact_duplicates(frame(spark, TEXTS), digest_all=True))
    normal = {i: lower_ascii(t or "") for i, t in TEXTS}
    for i, t in normal.items():
        same = [j for j in normal if normal[j] == t]
        row = got[i]
        assert (row.keep_id, row.group_size, row.kept, row.text_sha256) == (max(same), len(same), i == max(same), sha(t))
    assert got[7].group_size == got[8].group_size == 1  # only A-Z are folded


def test_exact_hashes_only_where_refinement_needs_it(spark):
    got = by_id(exact_duplicates(frame(spark, TEXTS)))
    assert got[10].text_sha256 is None and got[1].text_sha256 == sha("same text")
    # equal length and equal beginning: told apart by the whole text
    assert got[11].group_size == got[12].group_size == 1 and got[11].text_sha256 != got[12].text_sha256


def test_exact_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "a", 7), (1, "a", 8), (None, "a", 9), (None, "b", 1), (None, "b", 2)]
    df = frame(spark, rows, "doc_id long, text string, slot long").withColumnRenamed("slot", "survives")
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(df).collect()]
    assert Counter(got) == Counter([(1, 1, 3, True), (1, 1, 3, False), (None, 1, 3, False), (None, None, 2, True), (None, None, 2, False)])


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert exact_duplicates(empty).count() == 0
    assert byte_shards(empty).count() == 0
    assert remove_repeated_lines(empty).count() == 0


def check_shards(rows, got, n):
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    total = sum(r.size for r in got)
    largest = max(r.size for r in got)
    sizes, slots = Counter(), {}
    for r in got:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(sizes[k] - total / n) <= largest for k in range(n))
    in_order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.shard, r.slot))
    places = [(r.shard, r.slot) for r in in_order]
    assert places == sorted(places)  # contiguous in order of id


def test_shards_of_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    got = op4_byte_shards(spark, SMALL).collect()
    check_shards(rows, got, 16)
    texts = dict(rows)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_with_nulls_repeats_and_clashing_names(spark, n):
    rows = [(None, "a"), (None, None), (5, "é" * 50), (5, "é" * 50), (5, "z"), (6, ""), (7, LONG)]
    df = frame(spark, [(*r, 1, 2) for r in rows], "doc_id long, text string, part long, shard long")
    got = byte_shards(df, n).collect()
    check_shards(rows, got, n)
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)


PASSAGE = "one\ntwo\nthree\nfour"
LINES = [
    (1, f"start\n{PASSAGE}\nend"), (2, f"{PASSAGE}\nother"), (3, "a\nb"), (4, "a\nb"), (5, None), (6, ""), (7, PASSAGE),
    (8, "x\nx\nx\nx\nx"), (9, "\n\n\n\n"), (10, "two\nthree\nfive"), (11, f"q\n{PASSAGE}\r\nz"), (12, "line\n" * 20_000),
]


def test_lines_against_plain_python(spark):
    df = frame(spark, [(i, t, 1, "k") for i, t in LINES], "doc_id long, text string, line long, gone string")
    out = remove_repeated_lines(df)
    assert out.columns == ["doc_id", "text", "line", "gone", "_n_lines", "_n_removed"]
    got = by_id(out)
    assert {i: r.text for i, r in got.items()} == remove_lines(LINES)
    assert got[7].text == "" and got[7]._n_removed == got[7]._n_lines == 4
    assert got[2].text == "other" and got[3]._n_removed == 0 and (got[5]._n_lines, got[6]._n_lines) == (0, 0)
    left = by_id(drop_emptied(out))
    assert 7 not in left and {5, 6} <= set(left) and drop_emptied(out).columns == df.columns


def test_lines_of_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert {i: r.text for i, r in by_id(remove_repeated_lines(documents(spark))).items()} == remove_lines(rows)


def test_documents_of_many_lines_take_seconds(spark):
    """Removal grows with the lines of a document, not with their square."""
    import time

    lines = [f"line {i}" for i in range(400_000)]
    texts = {1: "\n".join(lines), 2: "\n".join(["own"] + lines[::-1][:3] + lines + ["end"]), 3: "\n".join(x for i in range(0, 100_000, 5) for x in (*lines[i : i + 4], f"new {i}"))}
    start = time.perf_counter()
    got = by_id(remove_repeated_lines(frame(spark, list(texts.items()))))
    assert time.perf_counter() - start < 60
    assert {i: sha(r.text) for i, r in got.items()} == {i: sha(t) for i, t in remove_lines(list(texts.items())).items()}
    assert got[2].text.split("\n")[0] == "own" and got[2]._n_removed == 400_000


def test_lines_of_repeated_and_null_ids(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (1, "e\nf\ng")]
    got = sorted((r.doc_id or 0, r.text) for r in remove_repeated_lines(frame(spark, rows)).collect())
    # the null id comes first and keeps its lines; rows that repeat id and text share a result
    assert got == [(0, "a\nb\nc"), (1, "d"), (1, "d"), (1, "e\nf\ng")]
