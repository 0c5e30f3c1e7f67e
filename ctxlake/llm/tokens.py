"""Token counts of parts of documents from one encoding of the whole text.

A document is encoded once with a byte-level vocabulary, whose tokens spell the text exactly, so token lengths give
each token's byte range. Sections are byte ranges too (lines by default); both lists are sorted, and joining them is one merge. A token that crosses
a boundary is given by ``rule``: ``first`` or ``last`` section it touches, ``most`` (the section that holds most of its bytes, the
earlier one if equal), or ``split`` (a share to each by bytes). Counts of the sections of a document sum to its tokens under
every rule.

The vocabulary (rank file of a public tokenizer) is read by the driver through its path and sent to the tasks; it has a
fixed size. Null or empty texts have no tokens and no sections.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

RULES = ("first", "last", "most", "split")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level vocabularies of this family cut a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(spark: SparkSession, path: str = VOCABULARY) -> dict[bytes, int]:
    """Ranks of a vocabulary file, read with Spark; the file of a tokenizer is small and does not grow with the data."""
    path = path if ":" in path else f"file://{path}"
    rows = spark.read.text(path).where("value <> ''").select(F.split("value", " ").alias("v")).collect()
    return {base64.b64decode(r[0][0]): int(r[0][1]) for r in rows}


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte ends of the tokens of a text."""
        return np.cumsum(self.sizes[np.array(self.encoding.encode_ordinary(text), np.int64)])


def line_ends(text: bytes) -> np.ndarray:
    """Lines with their line feeds."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) or not len(data) else np.append(ends, len(data))


def allocate(tokens: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; both arguments are byte ends of ranges that cover the text."""
    out = np.zeros(len(sections))
    starts = np.concatenate(([0], tokens[:-1]))
    first, last = np.searchsorted(sections, starts, "right"), np.searchsorted(sections, tokens, "left")
    whole = first == last
    np.add.at(out, first[whole], 1)
    for s, e, a, b in zip(starts[~whole].tolist(), tokens[~whole].tolist(), first[~whole].tolist(), last[~whole].tolist()):
        if rule in ("first", "last"):
            out[a if rule == "first" else b] += 1
            continue
        edges = np.concatenate(([s], sections[a:b], [e]))
        held = np.diff(edges)
        if rule == "most":
            out[a + int(np.argmax(held))] += 1
        else:
            out[a : b + 1] += held / (e - s)
    return out


def section_tokens(docs: DataFrame, ranks: dict[bytes, int], rule: str = "first") -> DataFrame:
    """``doc_id, section, start, end, n_tokens, doc_tokens``, one row for each line of each document; start and end count bytes."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            ids, columns = [], [[] for _ in range(5)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                tokens, ends = encoder.ends(text), line_ends(text.encode())
                n = len(ends)
                ids += [doc] * n
                found = (np.arange(n), np.concatenate(([0], ends[:-1])), ends, allocate(tokens, ends, rule), np.full(n, len(tokens)))
                for column, values in zip(columns, found):
                    column.append(values)
            if ids:
                names = ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(np.concatenate(c)) for c in columns]], names)

    schema = "doc_id bigint, section bigint, start bigint, end bigint, n_tokens double, doc_tokens bigint"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def field_tokens(df: DataFrame, id_col: str, fields: list[str], ranks: dict[bytes, int], rule: str = "first") -> DataFrame:
    """``id, field, n_tokens, doc_tokens``: the fields of a row are joined by line feeds, encoded once, and share its tokens.

    A field owns the line feed after it. Null fields count as empty; an empty field may own its line feed alone.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sent = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            out = []
            for row, *values in zip(*(c.to_pylist() for c in batch.columns)):
                parts = [f"{v or ''}\n" for v in values]
                parts[-1] = parts[-1][:-1]
                sizes = np.array([len(p.encode()) for p in parts])
                tokens = encoder.ends("".join(parts))
                counts = np.zeros(len(parts))
                full = np.flatnonzero(sizes)
                if len(full):
                    counts[full] = allocate(tokens, np.cumsum(sizes[full]), rule)
                out += [(row, f, n, len(tokens)) for f, n in zip(fields, counts.tolist())]
            if out:
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["id", "field", "n_tokens", "doc_tokens"])

    chosen = df.select(F.col(id_col).cast("bigint").alias("id"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    return chosen.mapInArrow(run, "id bigint, field string, n_tokens double, doc_tokens bigint")
