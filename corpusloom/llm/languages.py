"""Language identification by compression with one raw-content dictionary per language.

A text costs the fewest bytes with the dictionary of its own language. Each text is reduced to its
words in lower case and compressed whole, block by block, once per language; the smallest sum wins. The
margin to the second smallest is the score. Where it is narrow, the text is compressed once more at a
level that finds matches of three bytes, and what is still narrow is marked as rejected.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches

UNKNOWN = "und"
SAMPLE_DOCUMENTS = 64
SAMPLE_CHARACTERS = 4096
DICTIONARY_BYTES = 32_768
BLOCK_BYTES = 4096
LEVEL = 6
FINE_LEVEL = 19
MIN_MARGIN = 0.01
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def words_only(text: str) -> bytes:
    """Words of ``text`` in lower case, one space around each; ASCII digits and signs are left out."""
    return b" %b " % b" ".join(text.lower().encode().translate(_LETTERS).split())


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter of Unicode."""
    return text is not None and any(map(str.isalpha, text))


def learn_dictionaries(
    df: DataFrame, text_column: str = "text", lang_column: str = "lang", documents: int = SAMPLE_DOCUMENTS
) -> dict[str, bytes]:
    """The dictionary of each language in ``df``, the more frequent language first.

    It is made of the first ``SAMPLE_CHARACTERS`` of ``documents`` texts per language, those of least
    hash, up to ``DICTIONARY_BYTES``. Rows without a language or text are left out. Only the sample,
    bounded for each language, reaches the driver.
    """
    known = df.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL AND text <> ''"
    )
    order = Window.partitionBy("lang").orderBy("place", "text")
    head = known.select("lang", F.xxhash64("text").alias("place"), F.left("text", F.lit(SAMPLE_CHARACTERS)).alias("text"))
    sample = head.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= documents).collect()
    share = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    content: dict[str, list[bytes]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["rank"])):
        content.setdefault(row["lang"], []).append(words_only(row["text"]))
    names = sorted(content, key=lambda name: (-share.get(name, 0), name))
    return {name: b"".join(content[name])[:DICTIONARY_BYTES] for name in names if any(map(bytes.strip, content[name]))}


@lru_cache(maxsize=8)
def _compressors(contents: tuple[bytes, ...], level: int) -> list:
    import zstandard as z

    out = []
    for content in contents:
        finer = {"min_match": 3} if level == FINE_LEVEL else {}
        settings = z.ZstdCompressionParameters.from_level(
            level, source_size=BLOCK_BYTES, dict_size=len(content), write_content_size=False, write_checksum=False,
            write_dict_id=False, **finer,
        )
        book = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        book.precompute_compress(compression_params=settings)
        out.append(z.ZstdCompressor(dict_data=book, compression_params=settings))
    return out


class Classifier:
    """Compressors for the languages of ``dictionaries``, in its order."""

    def __init__(self, names: list[str], contents: tuple[bytes, ...], min_margin: float = MIN_MARGIN) -> None:
        self.names, self.min_margin = names, min_margin
        self.usual, self.fine = _compressors(contents, LEVEL), _compressors(contents, FINE_LEVEL)

    def _best(self, blocks: list[bytes], compressors: list) -> tuple[str, float]:
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(size for i, size in enumerate(sizes) if i != best)
        return self.names[best], 1.0 - sizes[best] / second

    def classify(self, text: str | None) -> tuple[str, float]:
        """``(language, score)``; ``und`` and 0 where there is no letter or nothing was learned.

        The score is the share of bytes that the best language saves against the second. A tie goes to
        the more frequent language, with score 0.
        """
        if not self.names or not has_letter(text):
            return UNKNOWN, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0
        line = words_only(text)
        blocks = [line[i:i + BLOCK_BYTES] for i in range(0, len(line), BLOCK_BYTES)]
        found = self._best(blocks, self.usual)
        return found if found[1] >= self.min_margin else self._best(blocks, self.fine)


def predict(
    df: DataFrame, dictionaries: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``id, lang_pred, score, rejected`` for every row, from the text alone.

    ``rejected`` is true where the margin is below ``min_margin`` or nothing could be said (``und``).
    NULL and empty texts give ``und``; long texts are compressed
    whole, block by block. An empty table gives an empty table. Repeated rows get equal results; other columns are ignored.
    """
    names, contents = list(dictionaries), tuple(dictionaries.values())
    shipped = df.sparkSession.sparkContext.broadcast(contents)  # DICTIONARY_BYTES per language

    def setup():
        judge = Classifier(names, shipped.value, min_margin)

        def work(keys, texts):
            found = [judge.classify(t) for t in texts]
            return [keys, [f[0] for f in found], [f[1] for f in found], [f[1] < min_margin for f in found]]

        return work

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = df.schema[id_column].dataType.simpleString()
    out = map_batches(narrow, f"id {kind}, lang_pred string, score double, rejected boolean", setup)
    return out.withColumnRenamed("id", id_column)


def held_out(row_id: Column) -> Column:
    """The third of the ids that is never learned from; a NULL id is not held out."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit(""))) % 3 == 1
