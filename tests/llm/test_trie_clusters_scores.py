"""Prefix trie, centroid clusters and lattice scores against plain Python, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids, lattice, prefix_trie
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import SMALL, frame, lower_ascii
from tools.compare import connect, differences

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_centroids"])
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL).toArrow(), connect(SMALL).execute(ORACLES[name]).to_arrow_table()) == []


# prefix trie


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    plain = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in convs.items()}
    found = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = plain.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return found


def trie(found):
    """Rows of the trie of ``{conversation: turns}``, walking every prefix."""
    members = defaultdict(set)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(found[c]) == len(p))
        rows.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows)


def nodes(df):
    return sorted(tuple(r) for r in df.collect())


def random_conversations(seed, n, longest):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(draw.choice([1, 2, 3, 5, 8, longest])):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "b", "é" * 3, ""]) if t < 4 or draw.random() < 0.9 else f"own {c}"))
    return rows


@pytest.mark.parametrize("height", [3])
def test_trie_equals_brute_force_at_any_band_height(spark, height):
    rows = random_conversations(5, 40, 21)
    turns, members = prefix_trie.rebuilt_turns(prefix_trie.ordered_turns(spark.createDataFrame(rows, TURNS)))
    assert nodes(prefix_trie.prefix_trie(turns, members, height)) == trie(rebuilt(rows))


def test_trie_of_awkward_rows(spark):
    rows = [
        (100, None, None, None), (100, 0, "user", "x"), (100, 0, "user", "x"), (100, 0, "assistant", "x"), (101, 3, "user", ""), (103, 1, "", "user"),
        (None, 0, "user", "lost"), (250, 0, "user", "base is absent"), (250, 1, "assistant", "y"), (7, 0, "user", "x" * 200_000), (107, 0, "user", "x" * 200_000),
        (-42, 0, "user", "negative"), (-42, 1, "user", "more"), (300, 0, "u", "ser"), (303, 0, "us", "er"),
    ]
    # columns whose names are those of the operator
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("conv", "depth", "owner", "position", "digest", "_part")})
    found = prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(prefix_trie.ordered_turns(df)))
    assert nodes(found) == trie(rebuilt(rows))


def test_one_very_long_conversation_and_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (0, 1) for t in range(200)] + [(c, 0, "user", "turn 0") for c in range(2, 400)]
    found = nodes(prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(prefix_trie.ordered_turns(spark.createDataFrame(rows, TURNS)))))
    assert found == trie(rebuilt(rows))


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    turns, members = prefix_trie.rebuilt_turns(prefix_trie.ordered_turns(empty))
    found = prefix_trie.prefix_trie(turns, members)
    assert found.count() == 0 and found.columns[0] == "conv_id"
    only = spark.createDataFrame([(5,)], "conv long")
    assert nodes(prefix_trie.prefix_trie(turns, only)) == [(5, 0, None, 1, 0, 1, 0, hashlib.sha256(b"5").hexdigest())]


def test_lists_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    ends = spark.createDataFrame([(0, 1, c) for c in range(50)] + [(1, 1, 7)], "owner long, depth long, conv long").repartition(5)
    found = {r.conv: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    assert found == {0: hashlib.sha256(",".join(map(str, range(50))).encode()).hexdigest(), 1: hashlib.sha256(b"7").hexdigest()}


# clusters


def kmeans(rows, dims, scale, k, rounds, salt):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{salt}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        met = defaultdict(list)
        for _, v in kept:
            met[nearest(v)[1]].append(v)
        for j, vectors in met.items():
            centres[j] = [sum(x) // len(vectors) for x in zip(*vectors)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=repr), centres


def test_clusters_equal_brute_force(spark):
    draw = random.Random(1)
    rows = [(i, [float(np.float32(draw.gauss(draw.choice([-1, 0, 1]), 0.4))) for _ in range(8)]) for i in range(500)]
    rows += [(i, rows[0][1]) for i in range(500, 700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for width, chunk_rows in ((2, 1 << 16), (8, 50)):
        assigned, found = centroids.cluster_vectors(df, "vec_id", "embedding", 8, 16, 5, 3, "s", width, chunk_rows)
        assert (sorted(map(tuple, assigned.collect()), key=repr), found) == kmeans(rows, 8, 16, 5, 3, "s")


def test_clusters_of_awkward_rows(spark):
    ok = [0.5, -0.25, 0.0, 3.0]
    rows = [
        (1, ok), (1, ok), (2, None), (3, []), (4, ok[:3]), (5, ok + [1.0]), (6, [float("nan"), 0.0, 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0, 0.0]),
        (8, [None, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (9, [-0.5, -0.5, -0.5, -0.5]), (10, ok),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("ints", "chunk", "part", "cluster")})
    assigned, found = centroids.cluster_vectors(df, "vec_id", "embedding", 4, 64, 16, 3, "1:")
    assert (sorted(map(tuple, assigned.collect()), key=repr), found) == kmeans(rows, 4, 64, 16, 3, "1:")
    # equal first centroids: the later ones stay empty and where they are
    assert len(found) == 5 and len({r.cluster for r in assigned.collect()}) == 3
    none, found = centroids.cluster_vectors(df.filter("vec_id = 2"), "vec_id", "embedding", 4, 64, 16, 3, "1:")
    assert none.count() == 0 and found == []
    assert centroids.with_totals(none, found).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.cluster_vectors(huge, "vec_id", "embedding", 4, 64, 16, 3, "1:")


def test_distances_of_the_largest_components_do_not_overflow(spark):
    most = float(centroids.largest_component(4) - 1)
    rows = [(1, [most] * 4), (2, [-most] * 4)]
    assigned, found = centroids.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 4, 1, 1, 2, "")
    assert (sorted(map(tuple, assigned.collect())), found) == kmeans(rows, 4, 1, 1, 2, "")


# lattice scores

PIECES = [(p, float(i)) for i, p in enumerate([b"a", b" a", b"ab", b"b", b" ab", b"abc", b"bc", "é".encode()] + [bytes([b]) for b in range(256) if chr(b) not in "ab"])]


def segmentations(word, pieces):
    """Probability and pieces of every segmentation."""
    if not word:
        yield 1.0, ()
        return
    for j in range(1, len(word) + 1):
        if word[:j] in pieces:
            for p, rest in segmentations(word[j:], pieces):
                yield pieces[word[:j]] * p, (word[:j], *rest)


def train(texts, rounds, smoothing):
    start = lattice.start_weights(PIECES)
    pieces, end = {p: math.exp(x) for p, x in zip(start.pieces, start.log_p)}, math.exp(start.log_end)
    words = Counter(w for t in texts for w in t.encode().lower().split())
    for _ in range(rounds if texts else 0):
        expected = dict.fromkeys(pieces, smoothing)
        for word, n in words.items():
            found = list(segmentations(b" " + word, pieces))
            total = sum(p for p, _ in found)
            for p, parts in found:
                for part in parts:
                    expected[part] += n * p / total
        total = sum(expected.values()) + len(texts)
        pieces, end = {p: e / total for p, e in expected.items()}, len(texts) / total
    return pieces, end, words


def brute_scores(rows, rounds=2, smoothing=0.1):
    texts = [t or "" for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    pieces, end, words = train(texts, rounds, smoothing)
    n, v = sum(words.values()) + len(texts), len(words) + bool(texts)
    found = []
    for i, t in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(t or ""))
        counts = [words[w.encode()] for w in own] + [len(texts)]
        score = sum(math.log10(sum(p for p, _ in segmentations(b" " + w.encode(), pieces))) for w in own) + math.log10(end)
        held_out = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        found.append((i, held_out, len(counts), sum(c > 0 for c in counts), n, sum(math.log10((c + 1) / (n + v + 1)) for c in counts), score))
    return found


def scores(df, **options):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    found = lattice.lattice_scores(df, ~held_out, PIECES, **options)
    return found.select("doc_id", ~F.col("learned"), *[c for c in found.columns if c not in ("doc_id", "learned")])


def alike(a, b):
    a, b = sorted(a, key=lambda r: repr(tuple(r)[:5])), sorted(b, key=lambda r: repr(r[:5]))
    assert [tuple(r)[:5] for r in a] == [r[:5] for r in b]
    for x, y in zip(a, b):
        assert tuple(x)[5:] == pytest.approx(y[5:], rel=1e-9), x


def awkward_texts():
    texts = ["abc ab\tAB a", "", None, " \n ", "é ß abcab", "a" * 12, "bc\x00c \x0b abc\x0cb", "▁a a b", "ABC abc Abc", "zz top"]
    return [(i, t) for i, t in enumerate(texts * 3)] + [(None, "ab"), (3, "abc"), (3, "abc")]


def test_scores_equal_all_segmentations(spark):
    rows = awkward_texts()
    df = frame(spark, rows).withColumns({c: F.lit(9) for c in ("word", "chunk", "places", "learn", "c", "log_p")})
    alike(scores(df.repartition(3)).collect(), brute_scores(rows))
    # chunks of a document each
    alike(scores(df, chunk_bytes=1).collect(), brute_scores(rows))
    alike(scores(df, rounds=0).collect(), brute_scores(rows, rounds=0))


def test_scores_of_nothing_and_without_training(spark):
    assert scores(frame(spark, [])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    alike(scores(frame(spark, [(only, "ab a"), (only, None)])).collect(), brute_scores([(only, "ab a"), (only, None)]))


def test_very_long_words(spark):
    """A word goes alone beyond ``SPAN`` bytes; the plain recursion of a long word agrees with the one of many words."""
    model, log_p = lattice.Lattice([p for p, _ in PIECES]), lattice.start_weights(PIECES).log_p
    word = b" " + b"abcab" * 200
    assert len(word) <= lattice.SPAN
    assert model.long_word(word, log_p) == pytest.approx(model.log_probabilities([word, b" a"], log_p)[0], rel=1e-12)
    rows = [(1, "ab" * 150_000), (2, "ab a"), (3, "é" * 1000)]
    found = {r.doc_id: r for r in scores(frame(spark, rows)).collect()}
    assert found[1].n_tokens == 2 and -math.inf < found[1].score < -10_000
    assert found[1].score < found[3].score < found[2].score < 0


def test_expected_counts_spell_the_words(spark):
    model, log_p = lattice.Lattice([p for p, _ in PIECES]), lattice.start_weights(PIECES).log_p
    words, counts = [b" abcab", b" \xc3\xa9a", b" " + b"ab" * 3000], np.array([3, 1, 2])
    expected = model.expected_counts(words, counts, log_p)
    assert expected @ [len(p) for p, _ in PIECES] == pytest.approx(sum(len(w) * n for w, n in zip(words, counts)))


def test_weights_add_up_and_more_rounds_fit_better(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = lattice.default_pieces()
    split = lattice.split_documents(docs, F.lit(True))
    words, ends = lattice.count_words(split), docs.count()
    totals = []
    for rounds in (0, 1, 2):
        weights = lattice.learn_weights(words, ends, lattice.start_weights(pieces), rounds)
        assert np.exp(weights.log_p).sum() + math.exp(weights.log_end) == pytest.approx(1)
        totals.append(lattice.score_words(words, weights).agg(F.sum(F.col("c") * F.col("log_p"))).first()[0] + ends * weights.log_end)
    assert totals[0] < totals[1] < totals[2]


def test_base_scores_equal_sql(spark):
    found = QUERIES["op13_lattice_score"](spark, SMALL)
    sql = r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        t AS (SELECT doc_id, unnest(list_append(w, chr(10))) AS w FROM d),
        c AS (SELECT w, count(*) AS c FROM t WHERE doc_id IN (SELECT doc_id FROM learned) GROUP BY w),
        n AS (SELECT sum(c) AS n, count(*) AS v FROM c)
        SELECT doc_id, count(*) AS n_tokens, count(c) AS n_known, max(n)::BIGINT AS train_tokens, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base
        FROM t LEFT JOIN c ON t.w = c.w CROSS JOIN n GROUP BY doc_id ORDER BY doc_id"""
    rows = found.orderBy("doc_id").collect()
    con = connect(SMALL)
    con.execute("CREATE TABLE learned (doc_id BIGINT)")
    con.executemany("INSERT INTO learned VALUES (?)", [(r.doc_id,) for r in rows if not r.held_out])
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows} == {True}
    expected = con.execute(sql).fetchall()
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [e[:4] for e in expected]
    assert [r.base_score for r in rows] == pytest.approx([e[4] for e in expected], rel=1e-9)
