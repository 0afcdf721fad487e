"""Language by compression: the language whose sample text helps most to compress a document."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table

#: Bounds of what is learned: documents sampled for each language, their longest length, and bytes kept of all of them.
SAMPLE_DOCS, SAMPLE_DOC_BYTES, DICTIONARY_BYTES = 96, 1 << 16, 112 << 10
MAX_LANGUAGES = 200
LEVEL = 6
#: Relative gap between the two smallest sizes below which a prediction counts as uncertain.
MARGIN = 0.01
#: How fast the score falls with the relative gap between sizes.
SHARPNESS = 40.0
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """One row in five, by its id; nothing is learned from these."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: What is compressed, for learning and predicting alike: lower-case words of letters, one space between them.
WORDS = r"[^\W\d_]+"


def plain(text: str) -> bytes:
    """Signs, digits, case and layout say nothing about the language and cost bytes under any dictionary."""
    words = re.findall(WORDS, text.lower())
    if words and not "".join(words).isalpha():
        # numerals such as fractions, circled digits and Roman numeral signs are no letters
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
    return " ".join(words).encode()


def learn_dictionaries(
    labelled: DataFrame, text_col: str = "text", label_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
    sample_doc_bytes: int = SAMPLE_DOC_BYTES, dictionary_bytes: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """Raw content for one zstandard dictionary per label, from whole texts of a bounded sample.

    Of each label the ``sample_docs`` distinct texts with the smallest hash are taken, of those with at most ``sample_doc_bytes``
    bytes. Hashes are made distinct by partial aggregates before they are ranked, so a much copied text takes one place and no
    task meets its copies; only the chosen texts are then read again. At most ``dictionary_bytes`` reach the dictionary. Null
    labels, null texts and texts without letters teach nothing; equal texts count once.
    """
    rows = labelled.select(labelled[label_col].cast("string").alias("label"), labelled[text_col].cast("string").alias("text"))
    rows = rows.filter(F.octet_length("text") <= sample_doc_bytes).withColumn("order", F.xxhash64("text"))
    usable = rows.filter(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("label").orderBy("order")
    ranked = usable.select("label", "order").distinct().withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= sample_docs)
    chosen: dict[str, list[int]] = {}
    for row in ranked.toLocalIterator():
        chosen.setdefault(row["label"], []).append(row["order"])
        if len(chosen) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # bounded by MAX_LANGUAGES times sample_docs
    wanted = labelled.sparkSession.createDataFrame([(label, k) for label, orders in chosen.items() for k in orders], "label string, order long")
    texts: dict[str, dict[int, bytes]] = {}
    for row in rows.join(F.broadcast(wanted), ["label", "order"]).dropDuplicates(["label", "order"]).toLocalIterator():
        texts.setdefault(row["label"], {})[row["order"]] = plain(row["text"])
    found = {}
    for label, by_order in sorted(texts.items()):
        joined = b" ".join(by_order[k] for k in sorted(by_order))
        found[label] = joined[-dictionary_bytes:].decode("utf-8", "ignore").encode()
    return found


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.languages = sorted(dictionaries)
        self.presses = []
        for language in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.presses.append(zstandard.ZstdCompressor(dict_data=content, level=level, write_content_size=False, write_dict_id=False))

    def sizes(self, raw: bytes) -> list[int]:
        return [len(press.compress(raw)) for press in self.presses]

    def predict(self, raw: bytes) -> tuple[str, float, float]:
        """Language, score and relative margin. Of equal sizes the language that sorts first wins, with margin 0."""
        sizes = self.sizes(raw)
        least = min(sizes)
        best = sizes.index(least)
        gaps = [(s - least) / least for s in sizes]
        others = [g for i, g in enumerate(gaps) if i != best]
        return self.languages[best], 1 / sum(math.exp(-SHARPNESS * g) for g in gaps), min(others, default=1.0)


def predict_language(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN,
    level: int = LEVEL,
) -> DataFrame:
    """``doc_id, lang_pred, score, margin, confident`` of every whole text.

    The words of each text are compressed once with every dictionary. ``lang_pred`` is ``und`` with score 0 for null texts, texts without a
    letter, and where nothing could be learned. ``confident`` is false for these and where the two smallest sizes are less than
    ``margin`` apart: callers that must not guess reject such rows. Only the text is read; repeated rows get equal results.
    """
    if not dictionaries:
        none = docs.select(docs[id_col].alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin"))
        return none.withColumn("confident", F.lit(False))
    # bounded by MAX_LANGUAGES times DICTIONARY_BYTES
    shared = docs.sparkSession.sparkContext.broadcast({"dictionaries": dictionaries})

    def run(batches):
        import pyarrow as pa

        held = shared.value
        if "classifier" not in held:
            held["classifier"] = Classifier(held["dictionaries"], level)
        predict = held["classifier"].predict
        for batch in batches:
            found = [predict(raw) if (raw := plain(text.as_py() or "")) else (UNKNOWN, 0.0, 0.0) for text in batch.column(1)]
            languages, scores, margins = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()),
                    pa.array([m >= margin and name != UNKNOWN for name, m in zip(languages, margins)], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "margin", "confident"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, margin double, confident boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = learn_dictionaries(docs.filter(~held_out(docs["doc_id"])))
    found = predict_language(docs, dictionaries)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "confident")
