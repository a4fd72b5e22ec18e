"""Language identification by compression (operator 8).

A language is represented by a raw-content zstandard dictionary of text in it.
A document is cut into blocks, each block is compressed once with every
language's dictionary, and the language with the smallest total wins: text
compresses best beside text of its own kind.  Blocks are compressed on their
own, so a long document cannot become its own dictionary, and every block of
the whole text counts.  What is compressed is the text's letters in lower case,
with one space for anything between them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import per_worker

UNDETERMINED = "und"

#: Bounded sample of the labelled rows: per language at most so many excerpts, of at most so many characters.
EXCERPTS = 512
EXCERPT_CHARS = 512
#: A dictionary's characters: of each excerpt so much is used that they fill it, in pieces that are judged apart.
DICTIONARY_CHARS = 32_768
PIECE_CHARS = 64
#: Bytes of a text that are compressed together, and zstandard's level.
BLOCK_BYTES = 1024
LEVEL = 11
#: A prediction is rejected if the runner-up needs less than this share more bytes.
MARGIN = 0.005
#: Bytes per code point are noisy for a few letters only; the score's scale, in bytes.
SCORE_BYTES = 4.0

#: Whole rows that a task hands back at a time.
OUT_ROWS = 500

NOT_LETTERS = re.compile(r"[\W\d_]+")


def train(labelled: DataFrame, text: Column, lang: Column, excerpts: int = EXCERPTS,
          excerpt_chars: int = EXCERPT_CHARS) -> dict[str, bytes]:
    """A dictionary per language of the rows whose text and language are not null.

    Every row takes part: the texts of a language fall into ``excerpts``
    buckets by hash, and each bucket keeps the excerpt of its smallest hash.
    Equal texts have one hash, so a text copied a thousand times weighs as
    much as any other; the excerpt starts at a place that the hash chooses.
    What reaches the driver is at most ``excerpts * excerpt_chars`` characters
    per language, whatever the number of rows."""
    rows = (labelled.select(text.alias("text"), lang.alias("lang")).filter("text is not null and lang is not null")
            .withColumn("h", F.xxhash64("text")))
    start = F.pmod(F.shiftrightunsigned("h", 20), F.greatest(F.char_length("text") - excerpt_chars, F.lit(0)) + 1)
    rows = rows.select("lang", "h", F.pmod("h", F.lit(excerpts)).alias("bucket"),
                       F.substring("text", (start + 1).cast("int"), F.lit(excerpt_chars)).alias("excerpt"))
    kept = (rows.groupBy("lang", "bucket").agg(F.min(F.struct("h", "excerpt"))["excerpt"].alias("excerpt"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "excerpt"))).alias("parts")))
    return dictionaries({r["lang"]: [p["excerpt"] for p in r["parts"]] for r in kept.collect()})


def letters(text: str) -> bytes:
    """What is compressed of a text."""
    return NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def _sequences(piece: bytes) -> list[tuple]:
    words = piece.split()[1:-1]          # whole words
    return list(zip(words, words[1:], words[2:]))


def dictionaries(excerpts: dict[str, list[str]]) -> dict[str, bytes]:
    """Raw dictionary content per language.

    A piece in another language (a quoted passage, a wrong label) would draw
    that language's documents.  Pieces whose word sequences stand in several
    languages' excerpts are passages that documents share and are left out;
    then each half of the excerpts is judged by dictionaries of the other half,
    and pieces that compress better elsewhere are left out too.  Neither rule
    takes more than half of a language."""
    parts = {}
    for lang, texts in excerpts.items():
        share = max(1, DICTIONARY_CHARS // (len(texts) * PIECE_CHARS)) * PIECE_CHARS
        parts[lang] = [letters(e[i:i + PIECE_CHARS]) for i in range(0, share, PIECE_CHARS) for e in sorted(texts) if i < len(e)]
    sequences = {lang: {t for e in p for t in _sequences(e)} for lang, p in parts.items()}
    where = Counter(t for seen in sequences.values() for t in seen)
    for lang, p in parts.items():
        own = [e for e in p if 2 * sum(where[t] > 1 for t in _sequences(e)) <= len(_sequences(e))]
        parts[lang] = own if 2 * len(own) >= len(p) else p
    halves = [Classifier({lang: b"".join(p[i::2]) for lang, p in parts.items()}) for i in (0, 1)]
    out = {}
    for lang, p in parts.items():
        place = halves[0].languages.index(lang)
        good = []
        for i, e in enumerate(p):
            sizes = halves[1 - i % 2].sizes(e)
            if sizes[place] == min(sizes):
                good.append(e)
        out[lang] = b"".join(good if 2 * len(good) >= len(p) else p)
    return out


class Classifier:
    """Per-task compressors, one per language, made from the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes], block_bytes: int = BLOCK_BYTES, level: int = LEVEL,
                 margin: float = MARGIN):
        self.block, self.margin = block_bytes, margin
        self.languages = sorted(dictionaries)
        self.compress = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compress.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False,
                                                          write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        blocks = [text[i:i + self.block] for i in range(0, len(text), self.block)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is wide enough."""
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        sizes = self.sizes(letters(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.languages[i]))
        best = sizes[order[0]]
        score = 1.0 / sum(math.exp(-(s - best) / SCORE_BYTES) for s in sizes)
        wide = len(order) == 1 or sizes[order[1]] - best >= max(1, self.margin * best)
        return self.languages[order[0]], score, wide


def _model(dictionaries: dict[str, bytes], block_bytes: int, margin: float) -> Classifier:
    key = ("language", block_bytes, margin, *((lang, zlib.crc32(d)) for lang, d in sorted(dictionaries.items())))
    return per_worker(key, lambda: Classifier(dictionaries, block_bytes, margin=margin))


def _decide(dictionaries: dict[str, bytes], block_bytes: int, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(dictionaries, block_bytes, margin)
        for batch in batches:
            out = [model.decide(t.as_py()) for t in batch.column(1)]
            lang, score, accepted = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(accepted, pa.bool_())], [batch.schema.names[0], "lang_pred", "score", "accepted"])
    return run


def identify_language(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id",
                      text_col: str = "text", block_bytes: int = BLOCK_BYTES, margin: float = MARGIN) -> DataFrame:
    """One row per document: ``id_col, lang_pred, score, accepted``.

    ``und`` with score 0 and not accepted if the text is null, empty or has no
    letter, or if nothing was learned; else the language of the smallest total
    (ties by code point), not accepted when the runner-up is within the margin.
    Repeated rows give repeated rows; extra columns are ignored."""
    schema = f"`{id_col}` bigint, lang_pred string, score double, accepted boolean"
    return docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col)).mapInArrow(
        _decide(dictionaries, block_bytes, margin), schema)


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns, in one pass without a shuffle."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(dictionaries, block_bytes, margin)
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):        # small batches back, not a second copy of a large one
                part = batch.slice(start, OUT_ROWS)
                yield part.filter(pa.array([model.decide(t.as_py())[2] for t in part.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
