"""Language by compression.

For every language of the labelled sample a raw-content dictionary of its text is
made. A text is compressed with each dictionary, and the language whose dictionary
gives the smallest output wins. Before compression a text is lower-cased and runs
of anything but letters become one space, so that figures, markup and rules don't
count. Long texts are compressed in pieces, all of them, so that the dictionary
matters throughout.

Cases: a null text, or one without a letter, gets ``und``, score 0, and is rejected;
so is every text if no language was learned. Equal sizes go to the language that
sorts first. With one language the score is 1. Rows may repeat; each is judged
for itself. Labelled rows with a null text or language teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsync.llm.common import id_remainder, table
from landsync.llm.registry import query

#: Bounds of the labelled sample: texts of a language, characters of a text, bytes of a dictionary. Up to 1,000
#: texts Spark cuts each language inside every task (its window group limit), so that no language meets in one task.
SAMPLE_TEXTS, SAMPLE_CHARS, DICT_BYTES = 1_000, 300, 32 * 1024
#: A text is compressed in pieces of so many bytes at a level; if the margin stays below
#: SURE_MARGIN, it is compressed anew in finer pieces at a higher level, which decides.
QUICK_LEVEL, QUICK_PIECE = 5, 8_192
FINE_LEVEL, FINE_PIECE = 12, 2_048
SURE_MARGIN = 0.03
#: A text is rejected if the best size is not smaller than the second by this share.
MIN_MARGIN = 0.004

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> bytes:
    """Letters and spaces; nothing if no character is a letter (number characters such as ½ are none)."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def language_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang",
                          key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary per language, from a bounded sample: a piece, from a hashed place, of each of the
    texts whose hashed id is smallest."""
    order = F.xxhash64(F.col(key).cast("string"))
    place = F.pmod(order, F.greatest(F.length(text) - SAMPLE_CHARS + 1, F.lit(1))) + 1
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.substring(F.col(text), place.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"),
        order.alias("order"))
    first = Window.partitionBy("lang").orderBy("order", "text")
    sample = (rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_TEXTS)
              .select("lang", "n", "text").collect())
    out: dict[str, bytes] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], r["n"])):
        out[r["lang"]] = (out.get(r["lang"], b"") + letters_of(r["text"]) + b" ")[:DICT_BYTES]
    return {k: v for k, v in out.items() if len(v) >= 8}


class Packers:
    """A compressor per language, at one level."""

    def __init__(self, dictionaries: dict[str, bytes], level: int, piece: int) -> None:
        self.piece, self.of = piece, []
        for name in sorted(dictionaries):
            data = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self.of.append((name, zstandard.ZstdCompressor(
                dict_data=data, level=level, write_checksum=False, write_content_size=False, write_dict_id=False)))

    def smallest(self, data: bytes) -> tuple[str, float]:
        """The language of the smallest output, and the share by which it is smaller than the second."""
        pieces = [data[i:i + self.piece] for i in range(0, len(data), self.piece)]
        sizes = sorted((sum(len(p.compress(x)) for x in pieces), name) for name, p in self.of)
        return sizes[0][1], 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.learned = bool(dictionaries)
        self.quick = Packers(dictionaries, QUICK_LEVEL, QUICK_PIECE)
        self.fine = Packers(dictionaries, FINE_LEVEL, FINE_PIECE)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score 0 to 1, accepted)"""
        data = letters_of(text)
        if not data or not self.learned:
            return "und", 0.0, False
        name, margin = self.quick.smallest(data)
        if margin < SURE_MARGIN:
            name, margin = self.fine.smallest(data)
        return name, 1.02 * margin / (margin + 0.02), margin >= MIN_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_accepted; no shuffle. The bounded
    dictionaries travel with the function. Columns of these names are replaced."""
    docs = docs.drop("lang_pred", "lang_score", "lang_accepted")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()),
                           T.StructField("lang_accepted", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for batch in batches:
            names, scores, accepted = [], [], []
            for t in batch.column(text).to_pylist():
                a, b, c = judge.classify(t)
                names.append(a)
                scores.append(b)
                accepted.append(c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(accepted, pa.bool_())],
                [*batch.schema.names, "lang_pred", "lang_score", "lang_accepted"])

    return docs.mapInArrow(run, schema)


def is_held_out(key: str = "doc_id"):
    return F.coalesce(id_remainder(key, 4) == 2, F.lit(False))


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language_dictionaries(docs.where(~is_held_out()))
    return identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", is_held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_accepted").alias("accepted"))
