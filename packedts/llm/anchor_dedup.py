"""Substring deduplication over words with difference-cover anchors.

A window is a number of consecutive words. Words are hashed at every place, but runs of
`anchor` words only at cover places: those whose number modulo the period lies in a difference
cover. For any two places there is a shift below the period that takes both to cover places,
so two equal windows share an anchor at the same shift, as long as window >= anchor + period - 1.

1. Blocks send the hashes of their anchors to buckets, which answer with those that more than
   one document holds.
2. Windows around such anchors are extended: they go to buckets under the 128-bit hash of
   their words, once per block with the least doc_id there; the bucket finds the least doc_id
   of all and answers to every block that has the window in a later document.
3. Blocks remove the words that answered windows cover.

A window or anchor goes to a bucket once per block, so a passage that a third of all documents
share stays as small there as the number of blocks. No pair of documents is ever formed.

Defined results: a null text has no words; documents shorter than a window lose nothing; rows
with equal doc_id remove nothing from each other; a null doc_id counts as larger than all
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from packedts.llm.blocks import NO_ID, Layout, blocked, bucket_of, dealt, id_and_text, in_id_order, joined, per_block, rows_table
from packedts.llm.textbytes import gram_hashes, groups, ranges, text_bytes, word_hashes, word_spans

# A perfect difference cover: every difference modulo the period is one of two cover places.
PERIOD, COVER = 7, (1, 2, 4)
KEYS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("more", pa.binary())])
WINDOWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("more", pa.binary()), ("least", pa.binary())])
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())]
)
_SQL = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


@dataclass
class Words:
    """The words of a block's documents, in order of doc_id."""

    ids: np.ndarray
    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray
    number: np.ndarray  # place of a word in its document
    left: np.ndarray  # words from here to the end of its document
    count: np.ndarray  # words per document

    @staticmethod
    def of(table: pa.Table) -> Words:
        table, ids = in_id_order(table)
        data, starts, ends = text_bytes(table.column("text"))
        first, last, doc = word_spans(data, starts, ends)
        count = np.bincount(doc, minlength=len(ids))
        begin = np.cumsum(count) - count
        number = np.arange(len(first)) - begin[doc]
        return Words(ids, data, first, last, doc, number, count[doc] - number, count)


def anchors_of(words: Words, hashes: np.ndarray, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every anchor: runs of words that start at a cover place."""
    at = np.flatnonzero(np.isin(words.number % PERIOD, COVER) & (words.left >= anchor))
    return at, gram_hashes(hashes, anchor)[at]


def windows_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of every window and two hashes of its words."""
    at = np.flatnonzero(words.left >= window)
    return at, *(gram_hashes(word_hashes(words.data, words.first, words.last, t), window)[at] for t in (0, 1))


def repeated_anchors(table: pa.Table) -> pa.Table:
    """Answer each block with its anchors that lie in more than one document of the corpus.

    The lowest bit of a key says that its block has it in more than one document.
    """
    keys, sizes = joined(table.column("keys"), "<u8")
    block = np.repeat(table.column("block").to_numpy(), sizes)
    base = keys >> np.uint64(1)
    order = np.argsort(base, kind="stable")
    at = groups(base[order])
    many = np.add.reduceat((keys[order] & np.uint64(1)).astype(np.int64), at) > 0 if len(at) else np.zeros(0, bool)
    size = np.diff(np.append(at, len(base)))
    hit = order[np.repeat(many | (size > 1), size)]
    hit = hit[np.argsort(block[hit], kind="stable")]
    return rows_table([(b, k, None) for b, k in dealt(block[hit], keys[hit] | np.uint64(1))], ANSWERS)


def first_documents(table: pa.Table) -> pa.Table:
    """For every window the least doc_id of all; answers go to blocks that hold a later document.

    The lowest bit of a first hash sent says that its block has the window in several documents;
    in an answer, that a document outside the block comes before all of them.
    """
    keys, sizes = joined(table.column("keys"), "<u8")
    more, _ = joined(table.column("more"), "<u8")
    least, _ = joined(table.column("least"), "<i8")
    block = np.repeat(table.column("block").to_numpy(), sizes)
    base = keys >> np.uint64(1)
    order = np.lexsort((more, base))
    new = (base[order][1:] != base[order][:-1]) | (more[order][1:] != more[order][:-1])
    at = np.flatnonzero(np.append(True, new)) if len(order) else np.zeros(0, np.int64)
    earliest = np.empty(len(order), np.int64)
    if len(order):
        earliest[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff(np.append(at, len(order))))
    hit = np.flatnonzero((earliest < least) | (keys & np.uint64(1) == 1))
    hit = hit[np.argsort(block[hit], kind="stable")]
    earlier = (earliest[hit] < least[hit]).astype(np.uint64)
    return rows_table(list(dealt(block[hit], keys[hit] & ~np.uint64(1) | earlier, more[hit])), ANSWERS)


def remove_repeated_windows(docs: DataFrame, window: int = 13, layout: Layout | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and kept_sha256, one row per document.

    A word goes if a window that covers it also starts in a document with a smaller doc_id.
    """
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"a window needs {PERIOD} words at least")
    texts = id_and_text(docs)
    layout = layout or Layout.of(texts)
    blocks = blocked(texts, layout)
    buckets = layout.buckets

    def send_anchors(table: pa.Table) -> pa.Table:
        words = Words.of(table)
        block = table.column("block")[0].as_py()
        at, keys = anchors_of(words, word_hashes(words.data, words.first, words.last), anchor)
        keys &= ~np.uint64(1)
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], words.ids[words.doc[at[order]]]
        g = groups(keys)
        if not len(g):
            return rows_table([], KEYS)
        several = ids[g] != ids[np.append(g[1:], len(ids)) - 1]  # ids grow within a group
        keys = keys[g] | several.astype(np.uint64)
        return rows_table([(b, block, k) for b, k in dealt(bucket_of(keys, buckets), keys)], KEYS)

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        repeated = np.sort(joined(answers.column("keys"), "<u8")[0])
        if not table.num_rows or not len(repeated):
            return rows_table([], WINDOWS)
        words = Words.of(table)
        block = table.column("block")[0].as_py()
        hashes = word_hashes(words.data, words.first, words.last)
        at, keys = anchors_of(words, hashes, anchor)
        place = np.minimum(np.searchsorted(repeated, keys | np.uint64(1)), len(repeated) - 1)
        hit = at[repeated[place] == keys | np.uint64(1)]
        # extend: all windows of the same document that hold the anchor
        edge = np.zeros(len(words.first) + 1, np.int32)
        np.add.at(edge, np.maximum(hit - (window - anchor), hit - words.number[hit]), 1)
        np.add.at(edge, hit + 1, -1)
        wanted = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (words.left >= window))
        first = gram_hashes(hashes, window)[wanted] & ~np.uint64(1)
        more = gram_hashes(word_hashes(words.data, words.first, words.last, 1), window)[wanted]
        order = np.lexsort((more, first))  # stable, so ids grow within a group
        first, more, ids = first[order], more[order], words.ids[words.doc[wanted[order]]]
        if not len(first):
            return rows_table([], WINDOWS)
        g = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (more[1:] != more[:-1])))
        several = ids[g] != ids[np.append(g[1:], len(ids)) - 1]
        keys = first[g] | several.astype(np.uint64)
        return rows_table([(b, block, *cols) for b, *cols in dealt(bucket_of(keys, buckets), keys, more[g], ids[g])], WINDOWS)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return rows_table([], RESULT)
        words = Words.of(table)
        gone = np.zeros(len(words.first), bool)
        keys, more = joined(answers.column("keys"), "<u8")[0], joined(answers.column("more"), "<u8")[0]
        if len(keys):
            order = np.lexsort((more, keys >> np.uint64(1)))
            outside, keys, more = keys[order] & np.uint64(1) == 1, keys[order] >> np.uint64(1), more[order]
            at, first, second = windows_of(words, window)
            first >>= np.uint64(1)
            lo = np.searchsorted(keys, first)
            hit = np.minimum(lo, len(keys) - 1)
            known = keys[hit] == first
            while (wrong := known & (more[hit] != second)).any():  # equal first hashes
                hit = np.where(wrong, hit + 1, hit)
                known &= hit < len(keys)
                hit = np.minimum(hit, len(keys) - 1)
                known &= keys[hit] == first
            at, hit = at[known], hit[known]
            ids = words.ids[words.doc[at]]
            own = np.full(len(keys), NO_ID)
            np.minimum.at(own, hit, ids)  # the least doc_id of the block with the window
            later = at[outside[hit] | (own[hit] < ids)]
            edge = np.zeros(len(gone) + 1, np.int32)
            np.add.at(edge, later, 1)
            np.add.at(edge, later + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
        removed = np.bincount(words.doc[gone], minlength=len(words.ids))
        # kept words with one space after each
        keep = np.flatnonzero(~gone)
        size = words.last[keep] - words.first[keep] + 1
        stop = np.cumsum(size)
        out = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
        out[ranges(stop - size, size - 1)] = words.data[ranges(words.first[keep], size - 1)]
        kept = np.cumsum(words.count - removed)
        offset = np.append(0, stop)
        rows = []
        raw = out.tobytes()
        for k, doc_id in enumerate(table.sort_by("doc_id").column("doc_id").to_pylist()):
            lo, hi = offset[kept[k - 1] if k else 0], offset[kept[k]]
            text = raw[lo : max(lo, hi - 1)]
            rows.append((doc_id, int(words.count[k]), int(removed[k]), text.decode(), hashlib.sha256(text).hexdigest()))
        return rows_table(rows, RESULT)

    anchors = blocks.groupBy("block").applyInArrow(send_anchors, ddl(KEYS))
    repeated = anchors.groupBy("bucket").applyInArrow(repeated_anchors, ddl(ANSWERS))
    windows = per_block(blocks, repeated, send_windows, ddl(WINDOWS))
    answers = windows.groupBy("bucket").applyInArrow(first_documents, ddl(ANSWERS))
    return per_block(blocks, answers, remove, ddl(RESULT))


def op9_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 13-word windows that an earlier document holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
