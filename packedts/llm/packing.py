"""Vector bin packing of token sequences by the dot-product heuristic.

Every document is tokenized, ended with one closing id, and cut into pieces that fill
sequences under three limits at once: tokens, segments, and tokens that bear loss. Full
windows of a document are sequences of their own; what is left of it is an item with a demand
vector. A bin takes, again and again, the item that fits and has the largest dot product of
its demand with the room that is left (both as shares of the limits). When nothing fits whole,
an item is cut to fill the room. A bin that stays short is laid out as sequences whose lengths
are powers of two, which need no padding.

Items are packed inside the Spark task that read them, so nothing is shuffled. A task holds
one Arrow batch of documents, and between batches only the items of one open bin.

Defined results: a null or empty text is the closing id alone; repeated rows are packed as
often as they occur; a null doc_id is kept; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END_ID = 1
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, ids binary"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], float)


def added_tokens(tokenizer_file: str) -> dict[str, int]:
    """The added tokens of a tokenizer file and their ids."""
    with open(tokenizer_file, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t[rule] for t in added for rule in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that depend on what stands around them are not known here")
    return {t["content"]: t["id"] for t in added}


def byte_bpe(ranks_file: str, pattern: str, added: dict[str, int] | None = None) -> Callable[[str], bytes]:
    """A tokenizer: text to little-endian unsigned 32-bit ids.

    Where an added token stands in a text its id does, and only the parts between are encoded;
    without added, such strings are ordinary text.
    """
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding(
        "byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary

    added_ids = {token: np.array([number], "<u4").tobytes() for token, number in (added or {}).items()}
    parted = re.compile("(" + "|".join(map(re.escape, sorted(added_ids, key=len, reverse=True))) + ")").split if added_ids else None

    def tokenize(text: str) -> bytes:
        if parted and any(map(text.__contains__, added_ids)):
            return b"".join(added_ids[p] if k % 2 else between(p) for k, p in enumerate(parted(text)))
        return between(text)

    def between(text: str) -> bytes:
        return np.array(encode(text), "<u4").tobytes()

    return tokenize


@dataclass
class Item:
    """The part of a document that is not yet placed."""

    doc_id: int | None
    start: int
    tokens: int
    loss: int
    doc_tokens: int
    ids: bytes

    def cut(self, tokens: int) -> Item:
        """Take the first tokens off; loss-bearing tokens are the last ones of an item."""
        free = self.tokens - self.loss
        piece = Item(
            self.doc_id, self.start, tokens, max(0, tokens - free), self.doc_tokens, self.ids[: 4 * tokens]
        )
        self.start += tokens
        self.tokens -= tokens
        self.loss -= piece.loss
        self.ids = self.ids[4 * tokens :]
        return piece


def fill_bins(items: list[Item], limits: Limits, last: bool) -> tuple[list[list[Item]], list[Item]]:
    """Bins by the dot-product heuristic, and the items of the bin that stayed open.

    With last, the open bin is closed as well.
    """
    bound = limits.vector()
    demand = np.array([(i.tokens, 1, i.loss) for i in items], float).reshape(-1, 3)
    share = demand / bound
    waiting = np.arange(len(items))
    bins: list[list[Item]] = []
    while len(waiting):
        used, held = np.zeros(3), []
        while len(waiting):
            room = bound - used
            fits = (demand[waiting] <= room).all(1)
            if fits.any():
                score = np.where(fits, share[waiting] @ (room / bound), -1.0)
                at = int(score.argmax())
                k = waiting[at]
                used += demand[k]
                held.append(items[k])
                waiting = np.delete(waiting, at)
                continue
            k = waiting[int(demand[waiting, 0].argmax())]
            free = items[k].tokens - items[k].loss
            part = int(min(room[0], free + room[2], items[k].tokens - 1))
            if room[1] < 1 or part < 1:
                break
            held.append(piece := items[k].cut(part))
            used += (piece.tokens, 1, piece.loss)
            demand[k] = (items[k].tokens, 1, items[k].loss)
            share[k] = demand[k] / bound
            break
        if not len(waiting) and not last and used[0] < limits.tokens:
            return bins, held
        bins.append(held)
    return bins, []


def sequences_of(held: list[Item], limits: Limits) -> Iterator[list[Item]]:
    """A full bin as it is; a short one cut into sequences with powers of two as lengths."""
    left = sum(i.tokens for i in held)
    if left == limits.tokens:
        yield held
        return
    queue = held[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            item = queue.pop()
            if item.tokens > size:
                part.append(item.cut(size))
                queue.append(item)
                break
            part.append(item)
            size -= item.tokens
        yield part


def pack(
    docs: DataFrame,
    tokenizer: Callable[[], Callable[[str], bytes]],
    limits: Limits | None = None,
    prompt_tokens: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, doc_tokens,
    sequence_id, offset, sequence_tokens and the ids as little-endian unsigned 32-bit numbers.

    tokenizer makes the tokenizer in the task. prompt_tokens names a column with the number of
    leading tokens that bear no loss; without it every token bears loss.
    """
    limits = limits or Limits()
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("every limit must be at least 1")
    prompt = F.coalesce(F.col(prompt_tokens).cast("long"), F.lit(0)) if prompt_tokens else F.lit(0).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        prompt.alias("prompt"),
    )
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens")]
        + [("ids", pa.binary())]
    )
    end = np.array([END_ID], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenize, open_items = tokenizer(), []
        serial = TaskContext.get().partitionId() << 40

        def emit(bins: list[list[Item]]) -> pa.RecordBatch:
            nonlocal serial
            out: list[tuple] = []
            for held in bins:
                for sequence in sequences_of(held, limits):
                    total, at = sum(i.tokens for i in sequence), 0
                    for i in sequence:
                        out.append((i.doc_id, i.start, i.tokens, i.doc_tokens, serial, at, total, i.ids))
                        at += i.tokens
                    serial += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 8, schema)], schema=schema
            )

        def windows(batch: pa.RecordBatch) -> Iterator[Item]:
            for doc_id, text, prompt in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = tokenize(text) + end
                n = len(ids) // 4
                step = min(limits.tokens, max(limits.loss_tokens, 1))
                for start in range(0, n, step):
                    size = min(step, n - start)
                    loss = max(0, min(size, start + size - max(0, prompt)))
                    yield Item(doc_id, start, size, loss, n, ids[4 * start : 4 * (start + size)])

        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                whole, rest = [], open_items
                for item in windows(batch.slice(lo, 2000)):
                    if item.tokens == limits.tokens:
                        whole.append([item])
                    else:
                        rest.append(item)
                bins, open_items = fill_bins(rest, limits, last=False)
                yield emit(whole + bins)
        if open_items:
            yield emit(fill_bins(open_items, limits, last=True)[0])

    return rows.mapInArrow(task, PIECES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pack(docs, lambda: byte_bpe(ranks, pattern, added))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
