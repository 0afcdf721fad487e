"""Language, toxicity and chat examples: held-out accuracy, marginals against enumeration, round trips."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, language, toxicity
from tests.llm.helpers import SMALL, by_id, documents, frame, held_out, sha

LARGER = "/root/testdata/sf0.1"
pick = random.Random(1)
SOUNDS = {"aa": "ba be bi bo bu da de".split(), "bb": "kri kra kro stri stra stro".split(), "cc": "lou mou nou pou rou sou".split()}


def said(lang, n):
    return " ".join("".join(pick.choice(SOUNDS[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(n))


def test_language_of_held_out_documents(spark):
    got = by_id(language.op1_language_id(spark, LARGER).join(documents(spark, LARGER).select("doc_id", "lang", "n_chars"), "doc_id"))
    assert len(got) == documents(spark, LARGER).count()
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and (r.confident or r.margin < language.MARGIN) for i, r in got.items())
    unseen = [r.lang == r.lang_pred for r in got.values() if r.held_out]
    assert len(unseen) > 1000 and np.mean(unseen) > 0.97
    sure = [r.lang == r.lang_pred for r in got.values() if r.held_out and r.confident]
    assert np.mean(sure) > np.mean(unseen)


def test_language_of_awkward_texts(spark):
    rows = [(i, said(lang, 60), lang) for i, lang in enumerate(list(SOUNDS) * 20)] + [(900, None, "aa"), (901, "12 !", "bb"), (902, said("aa", 9), None)]
    labelled = frame(spark, rows, "doc_id long, text string, lang string")
    dictionaries = language.learn_dictionaries(labelled)
    assert sorted(dictionaries) == list(SOUNDS) and max(map(len, dictionaries.values())) <= language.DICTIONARY_BYTES
    assert dictionaries == language.learn_dictionaries(labelled.repartition(7))
    texts = [
        (1, None), (2, ""), (3, " 123 ... "), (4, said("aa", 40)), (5, said("bb", 40).upper()), (6, said("cc", 60_000)), (7, "x"), (8, said("aa", 5) + "!" * 5000),
        (None, said("bb", 30)), (4, "bada"),
    ]
    out = language.predict_language(frame(spark, [(*t, "zz", 5.0) for t in texts], "doc_id long, text string, lang string, score double"), dictionaries)
    got = {(r.doc_id, r.margin): r for r in out.collect()}
    assert len(got) == len(texts)
    found = {r.doc_id: r.lang_pred for r in got.values() if r.doc_id not in (4, 7)}
    assert found == {1: "und", 2: "und", 3: "und", 5: "bb", 6: "cc", 8: "aa", None: "bb"}
    assert all(r.score == 0 and not r.confident for r in got.values() if r.lang_pred == "und")
    assert language.predict_language(labelled.filter("false"), dictionaries).count() == 0
    nothing = language.predict_language(labelled, language.learn_dictionaries(labelled.filter("lang IS NULL")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_numerals_and_marks_alone_have_no_language(spark):
    """The texts of which ``und`` is the language are those without a letter, for learning and predicting alike."""
    dictionaries = {"aa": b"bada bibo", "bb": b"kri stra"}
    texts = ["\u00bd \u00b2 \u2167 \u2460", "\u0661\u0662", "\u0301\u0308", "\u2028_7", "\u00bda\u00bd", "\u2167 kri", "\u4e00"]
    got = by_id(language.predict_language(frame(spark, list(enumerate(texts))), dictionaries))
    letters = frame(spark, list(enumerate(texts))).filter(F.col("text").rlike(r"\p{L}"))
    assert {i for i, r in got.items() if r.lang_pred != "und"} == {r.doc_id for r in letters.collect()} == {4, 5, 6}
    assert language.plain(texts[4]) == b"a" and language.plain(texts[5]) == b"kri"


def test_predictions_equal_sizes_from_plain_zstandard(spark):
    """Brute force: compress every text's words anew with each dictionary and take the smallest."""
    import zstandard

    docs = documents(spark)
    dictionaries = language.learn_dictionaries(docs)
    names = sorted(dictionaries)
    made = {name: zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT) for name in names}
    for content in made.values():
        content.precompute_compress(level=language.LEVEL)
    got = {r.doc_id: r.lang_pred for r in language.predict_language(docs, dictionaries).collect()}
    for row in docs.collect():
        words = "".join(c if c.isalpha() else " " for c in (row.text or "").lower()).split()
        if not words:
            assert got[row.doc_id] == "und"
            continue
        raw = " ".join(words).encode()
        sizes = {n: len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=made[n], write_content_size=False, write_dict_id=False).compress(raw)) for n in names}
        assert sizes[got[row.doc_id]] == min(sizes.values()), row.doc_id


def test_sample_of_languages_is_bounded(spark):
    rows = [(i, said("aa", 50), "aa") for i in range(300)]
    few = language.learn_dictionaries(frame(spark, rows, "doc_id long, text string, lang string"), sample_docs=3)
    assert len(few["aa"]) < 4 * max(len(t) for _, t, _ in rows)


def test_copies_take_one_place_in_the_sample_of_a_language(spark):
    rows = [(i, said("aa", 40), "aa") for i in range(50)]
    distinct = frame(spark, rows, "doc_id long, text string, lang string")
    least = distinct.orderBy(F.xxhash64("text")).first().text
    copied = frame(spark, rows + [(1000 + i, least, "aa") for i in range(200)], "doc_id long, text string, lang string")
    found = language.learn_dictionaries(copied)
    assert found == language.learn_dictionaries(distinct)
    assert all(language.plain(text) in found["aa"] for _, text, _ in rows)


def test_marginals_and_pair_counts_by_enumeration():
    random_ = np.random.default_rng(0)
    model = toxicity.Field(moves=((0.3, -1.0), (-0.5, 0.8)), start=(0.2, -0.4))
    lengths = [1, 3, 2, 9, 1, 6]
    scores = [random_.normal(size=k) * 2 for k in lengths]
    marginal, pairs = [], np.zeros((2, 2))
    for x in scores:
        weights = {}
        for states in itertools.product((0, 1), repeat=len(x)):
            total = model.start[states[0]] + sum(model.moves[a][b] for a, b in itertools.pairwise(states)) + sum(v for v, s in zip(x, states) if s)
            weights[states] = np.exp(total)
        whole = sum(weights.values())
        marginal += [sum(w for s, w in weights.items() if s[t]) / whole for t in range(len(x))]
        for s, w in weights.items():
            for a, b in itertools.pairwise(s):
                pairs[a, b] += w / whole
    first = np.concatenate([[True] + [False] * (k - 1) for k in lengths])
    got, got_pairs = toxicity.marginals(np.concatenate(scores), first, model)
    assert np.allclose(got, marginal) and np.allclose(got_pairs, pairs)


def test_marginals_of_long_documents_do_not_depend_on_layout():
    random_ = np.random.default_rng(2)
    model = toxicity.Field(moves=((2.0, -2.0), (-2.0, 2.0)), start=(0.0, -1.0))
    x = random_.normal(size=5000) * 8
    first = np.zeros(5000, bool)
    first[[0, 1234]] = True
    whole, _ = toxicity.marginals(x, first, model)
    second, _ = toxicity.marginals(x[1234:], first[1234:], model)
    assert np.allclose(whole[1234:], second) and np.isfinite(whole).all()
    assert len(toxicity.marginals(x[:0], first[:0], model)[0]) == 0


def toxic_sample(n):
    rows = []
    for i in range(n):
        words = said("aa", 60).split()
        if i % 3 == 0:
            for bad in pick.sample(["grumpf", "snarkel", "blorx"], 2):
                words.insert(pick.randrange(len(words)), bad + pick.choice(["", "s", "er"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    return rows


def test_toxic_spans_and_scores(spark):
    rows = toxic_sample(300)
    docs, labels = frame(spark, rows, "doc_id long, text string, x long"), frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.learn_field(docs, labels)
    got = by_id(toxicity.score_toxicity(docs.withColumnRenamed("x", "spans"), model))
    for i, text, y in rows:
        assert got[i].predicted == y and (got[i].score >= 0.5) == bool(y)
        for span in got[i].spans:
            assert any(bad in text[span.start : span.end] for bad in ("grumpf", "snarkel", "blorx")) and 0.5 <= span.probability <= 1
        assert bool(got[i].spans) == bool(y)

    texts = [(1, None), (2, ""), (3, "1 2 ..."), (4, "Éé İ " + "bada " * 9 + "BLORX!!"), (5, said("aa", 50_000)), (6, said("aa", 50_000) + " grumpf snarkel"), (None, "ba")]
    odd = {r.doc_id: r for r in toxicity.score_toxicity(frame(spark, texts), model).collect()}
    assert [odd[i].predicted for i in (1, 2, 3, 4, 5, 6, None)] == [0, 0, 0, 1, 0, 1, 0]
    assert texts[3][1][odd[4].spans[0].start : odd[4].spans[0].end] == "BLORX"
    assert odd[1].score == odd[2].score == odd[3].score


def test_field_is_fitted_to_the_whole_sample():
    texts = [(text, bool(y)) for _, text, y in toxic_sample(1500)]
    late = [(f"{said('aa', 30)} zwixel {said('aa', 30)}", True) for _ in range(60)]
    model = toxicity.fit_field(texts + late)
    assert model.weights.get("wzwixel", 0) > 0
    measures, _ = toxicity.document_measures(model, [text.split() for text, _ in late])
    assert all(top >= 0.5 for top, _ in measures)


def test_fit_does_not_depend_on_chunks():
    texts = [(text, bool(y)) for _, text, y in toxic_sample(200)] + [("", True), ("1 2", False)]
    whole, parted = toxicity.fit_field(texts), toxicity.fit_field(texts, chunk_tokens=700)
    assert whole.weights and whole.weights.keys() == parted.weights.keys()
    assert all(abs(w - parted.weights[f]) < 1e-6 for f, w in whole.weights.items())
    assert np.allclose([whole.bias, *whole.score, *whole.start], [parted.bias, *parted.score, *parted.start])


def test_toxicity_without_labels_and_with_odd_ones(spark):
    rows = toxic_sample(30)
    docs = frame(spark, [r[:2] for r in rows])
    odd = frame(spark, [(None, 1), (1, None), (99, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    for labels in (odd, odd.filter("false")):
        out = toxicity.score_toxicity(docs, toxicity.learn_field(docs, labels)).collect()
        assert len(out) == 30 and all(r.predicted == 0 and not r.spans and 0 <= r.score < 0.5 for r in out)


def test_held_out_labels_teach_nothing(spark):
    rows = [r for r in toxic_sample(200) if held_out(r[0])]
    docs, labels = frame(spark, [r[:2] for r in rows]), frame(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert toxicity.learn_field(docs, labels) == toxicity.Field()


def test_toxicity_of_held_out_documents(spark):
    got = toxicity.op10_toxicity(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.97
    assert np.mean([r.predicted for r in got if r.toxic == 1]) > 0.85 and np.mean([r.predicted for r in got if r.toxic == 0]) < 0.01


CONTROL = "</s>[INST] ok [/INST]"
TALKS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 4, "assistant", "no"), (1, 5, "user", "last"),
    (2, 3, "assistant", CONTROL), (2, 1, "user", CONTROL), (2, 2, "assistant", r"<\s> <\\/s> [\/INST] \ [x] <s"), (3, 0, "user", None), (3, 1, "assistant", ""),
    (4, 0, None, "who"), (4, None, "[/INST]", "\n</s\n"), (5, 0, "assistant", "é😀" * 9), (5, 0, "assistant", "é😀" * 9), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
    (6, 0, "assistant", "word " * 50_000),
]


def wanted_digests(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        found[conv] = (len(turns), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)), len(loss), sha(loss))
    return found


def test_chat_round_trip(spark):
    df = frame(spark, [(*r, 1, 2) for r in TALKS], "conv_id long, turn long, role string, text string, part long, position long")
    formatted = chat.format_conversations(df).cache()
    got = by_id(chat.conversation_digests(formatted, chat.examples(formatted)), "conv_id")
    assert {i: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for i, r in got.items()} == wanted_digests(TALKS)
    rows = formatted.collect()
    for conv in got:
        turns = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in turns] == list(range(len(turns)))
        text = "".join(r.formatted for r in turns)
        assert got[conv].formatted_chars == len(text) and all(text[r.char_start : r.char_end] == r.formatted for r in turns)
    assert chat.format_conversations(df.filter("false")).count() == 0


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    formatted = chat.format_conversations(frame(spark, TALKS, "conv_id long, turn long, role string, text string")).cache()
    examples = chat.examples(formatted)
    assert {(r.conv_id, r.number) for r in examples.collect()} == {(1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (5, 0), (5, 1), (None, 0), (6, 0)}
    texts = {(r.conv_id, r.number): r for r in chat.render(formatted, examples.filter("conv_id IN (1, 2)")).collect()}
    one = texts[1, 1]
    assert one.text == "<s>[INST]system[/INST]be kind</s><s>[INST]user[/INST]hi</s><s>[INST]assistant[/INST]hello</s><s>[INST]user[/INST]more</s><s>[INST]assistant[/INST]no</s>"
    assert one.text[one.loss_start : one.loss_end] == "no" and texts[1, 0].text == one.text[: len(texts[1, 0].text)]
    two = texts[2, 1]
    assert chat.unescape(two.text[two.loss_start : two.loss_end]) == CONTROL and two.text.count("</s>") == 3 and two.text.count("[/INST]") == 3


def test_chat_of_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)]
    got = by_id(chat.op9_chat_examples(spark, SMALL), "conv_id")
    assert {i: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for i, r in got.items()} == wanted_digests(rows)


@pytest.mark.parametrize("text", [CONTROL, r"<\s>", r"[\\/INST]", "<<s>>", r"\<s>\\", "[INST", "", r"<\\\/s>[\INST]"])
def test_escape_is_reversible(spark, text):
    escaped = frame(spark, [(1, text)]).select(chat.escape("text").alias("e")).first().e
    assert chat.unescape(escaped) == text and not any(c in escaped for c in ("<s>", "</s>", "[INST]", "[/INST]"))
