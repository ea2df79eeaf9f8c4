"""Section text -> ordered, overlapping chunks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ids
from ledgerloom.functions.bind import let

# Chunk size and overlap in characters.
CHUNK_SIZE = 2000
CHUNK_OVERLAP = 200
SEPARATORS = ("\n\n", "\n", " ", "")


def fixed_pieces(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` characters, each beginning ``size - overlap`` after the one before.

    The text is cut once into strides and windows are joined from neighbours: one pass over the text,
    where taking substrings would count characters from the start for every piece.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    stride = size - overlap
    neighbours = -(-size // stride)
    count = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(stride))).cast("int") + 1

    def windows(strides: Column) -> Column:
        return F.transform(
            F.slice(strides, F.lit(1), count),
            lambda _, i: F.substring(F.array_join(F.slice(strides, i + 1, F.lit(neighbours)), ""), 1, size),
        )

    cut = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0)), windows)
    return F.when(F.length(text) <= size, F.when(text != "", F.array(text)).otherwise(F.array())).otherwise(cut)


def recursive_pieces(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators: tuple[str, ...] = SEPARATORS):
    """Arrow-batched function: cut at the coarsest separator that works, then pack up to ``size``.

    Gives (start, text) for each piece; ``start`` counts characters from 0. A null text has no pieces.
    """
    from ledgerloom.operators.recursive_split import split_spans

    @F.arrow_udf("array<struct<start: int, text: string>>")
    def pieces(texts: pa.Array) -> pa.Array:
        offsets, starts, cut = [0], [], []
        for text in texts.to_pylist():
            spans = split_spans(text, size, overlap, separators) if text else []
            starts.extend(begin for begin, _ in spans)
            cut.extend(text[begin:end] for begin, end in spans)
            offsets.append(len(cut))
        made = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(cut, pa.string())], ["start", "text"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), made)

    return pieces


def chunk_sections(sections: DataFrame, pieces: Column) -> DataFrame:
    """Sections (formId, f10kItem, text, ...) -> chunks with chunkId and chunkSeqId counted from 0."""
    carried = [c for c in sections.columns if c != "text"]
    return sections.select(*carried, F.posexplode(pieces).alias("chunkSeqId", "text")).withColumn(
        "chunkId", ids.chunk_id(F.col("formId"), F.col("f10kItem"), F.col("chunkSeqId"))
    )


def chunk_fixed(sections: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    return chunk_sections(sections, fixed_pieces(F.col("text"), size, overlap))


def chunk_recursive(
    sections: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = SEPARATORS,
    start: str | None = None,
) -> DataFrame:
    """Chunks cut at natural breaks; ``start`` names a column for the place of each in its section's text."""
    found = chunk_sections(sections, recursive_pieces(size, overlap, separators)(F.col("text")))
    place = {start: F.col("text.start")} if start else {}
    return found.withColumns({**place, "text": F.col("text.text")})
