"""Token counts by section, from one encoding of each whole document.

A tokenizer joins characters across section boundaries, so sections can't be encoded one by one.
Each document is encoded once; the bytes of its tokens give every token's span, and the spans are
joined with the sections' spans, both in order. A token inside one section counts there. A token
that crosses a boundary is allocated by a named rule:

``start``    the section of its first byte,
``end``      the section of its last byte,
``largest``  the section with most of its bytes, the first of equals,
``share``    every section, by its share of the bytes.

The vocabulary is read from a path, its size is checked, and it is sent to the executors once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_VOCABULARY_BYTES = 32_000_000
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "end", "largest", "share")

COUNTS = "doc_id long, section long, start_char long, end_char long, n_tokens double, n_crossing long"


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes, pattern: str):
    """The encoder and the number of bytes of each token."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def line_bounds(text: str) -> np.ndarray:
    """Starts of the lines in code points and the end; a line holds its line break."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.concatenate([[0], np.flatnonzero(points == 10) + 1, [points.size]])


def _byte_places(text: str, chars: np.ndarray) -> np.ndarray:
    """The byte offset in UTF-8 of each code point offset."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate([[0], np.cumsum(size)])[chars]


def attributed(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per section, tokens that cross into or out of it) for tokens that end at ``ends`` and
    sections between neighbouring ``bounds``, both tiling the same bytes."""
    n = bounds.size - 1
    starts = np.concatenate([[0], ends[:-1]])
    # Of empty sections at one place the last one holds the place.
    first = np.clip(np.searchsorted(bounds, starts, side="right") - 1, 0, n - 1)
    last = np.clip(np.searchsorted(bounds, ends - 1, side="right") - 1, 0, n - 1)
    counts = np.bincount(first[first == last], minlength=n).astype(np.float64)
    crossing = np.zeros(n, dtype=np.int64)
    for token in np.flatnonzero(first != last):
        own = np.arange(first[token], last[token] + 1)
        share = np.minimum(bounds[own + 1], ends[token]) - np.maximum(bounds[own], starts[token])
        crossing[own[share > 0]] += 1
        if rule == "share":
            counts[own] += share / share.sum()
        else:
            counts[{"start": own[0], "end": own[-1], "largest": own[np.argmax(share)]}[rule]] += 1
    return counts, crossing


def _count(vocabulary_sent, pattern: str, rule: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoding(vocabulary_sent.value, pattern)
        for batch in batches:
            for piece in pieces(batch):
                yield counted(piece, encoding, lengths)

    def counted(batch: pa.RecordBatch, encoding, lengths: np.ndarray) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], [], []]
        for doc, text in zip(batch.column("doc_id"), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            tokens = encoding.encode_to_numpy(text, disallowed_special=())
            chars = line_bounds(text)
            counts, crossing = attributed(np.cumsum(lengths[tokens]), _byte_places(text, chars), rule)
            sections = np.arange(counts.size)
            for column, values in zip(columns, (None, sections, chars[:-1], chars[1:], counts, crossing), strict=True):
                column.append(pa.repeat(doc, counts.size) if values is None else pa.array(values))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
        names = [f.split()[0] for f in COUNTS.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([a.cast(t) for a in c]) if c else pa.array([], t) for c, t in zip(columns, types, strict=True)], names=names
        )

    return count


def section_tokens(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: str = "start", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per line of each input row: doc_id, section (from 0), start_char, end_char (code points,
    exclusive), n_tokens (a double, whole unless shared), n_crossing (tokens it shares with others).

    The lines tile the text, so a document's counts add up to its number of tokens. A null or empty
    text has one empty line without tokens. Repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as file:
        ranks = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(ranks) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} has more than {MOST_VOCABULARY_BYTES} bytes")
    sent = documents.sparkSession.sparkContext.broadcast(ranks)
    own = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(_count(sent, pattern, rule), COUNTS)
