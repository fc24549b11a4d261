"""Substring deduplication over bytes with suffix order and longest-previous-factor arrays.

1. A window of `length` bytes is filed under the least hash of the grams in it (its key), so
   equal windows share a key and neighbouring windows mostly do, too. Blocks send their keys
   to buckets, which answer with the keys that more than one document holds.
2. For those keys, blocks send the bytes of each run of windows under one key (a fragment),
   each different fragment once per block. A bucket sorts suffixes of its fragments, shares the lengths of
   the common prefixes of neighbours, and takes from the previous and the next suffix of a smaller document
   the longest previous factor of each: how many bytes from there on, up to the end of its fragment, also start in
   an earlier document. A fragment whose first factor reaches its end goes as a whole, so copies are found by
   the same array; of others the windows go whose factor has at least a window's length.
   A copy sends only its longest suffix to the order, for its others are those of the first copy.
3. Blocks remove every byte that such a window covers; the first copy stays.

A key that very many documents hold is split: its windows are filed under the hash of all
their bytes instead, of which a block sends each at most once. So a group that a third of all
documents share stays as small as the number of blocks, and no pair is ever formed.

Defined results: a null text is empty; texts shorter than a window lose nothing; rows with
equal doc_id remove nothing from each other; a null doc_id counts as larger than all others;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from packedts.llm.blocks import Layout, blocked, bucket_of, dealt, id_and_text, in_id_order, joined, per_block, rows_table
from packedts.llm.textbytes import gram_hashes, groups, mixed, ranges, text_bytes, window_minimum

GRAM = 20
LONGEST_RUN = 64
HOT = 1024
PORTION = 200_000
STRIDE = 64
LOW = np.uint64(3)
# by number of bytes kept: a mask of the first ones of a word; the least words of 1 to 8 bytes
KEPT_BYTES = np.array([0, *(((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(1, 9))], np.uint64)
BYTE_STEPS = np.array([1 << 8 * k for k in range(8)], np.uint64)

KEYS = "bucket long, block long, keys binary"
ANSWERS = "block long, keys binary, place binary, least binary, run_place binary, run_from binary, run_to binary"
FRAGMENTS = "bucket long, block long, keys binary, place binary, least binary, size binary, bytes binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


# --- suffix order and longest previous factors ------------------------------------------


def suffix_order(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes data[at : at + size] in order of their bytes, a prefix of another before it.

    Also the number of bytes that each shares with the one before it. STRIDE bytes are
    sorted at a time, after the first time only those of suffixes that are still equal to a neighbour.
    data goes on for STRIDE bytes of any value behind the last suffix.
    """
    order, shared = np.arange(len(at)), np.zeros(len(at), np.int64)
    if not len(at):
        return order, shared
    strides = np.lib.stride_tricks.sliding_window_view(data, STRIDE)
    group, places, depth = np.zeros(len(at), np.int64), np.arange(len(at)), 0
    while len(places):
        row = order[places]
        left = np.clip(size[row] - depth, 0, STRIDE)
        words = strides[at[row] + depth].view(">u8").astype(np.uint64)
        words &= KEPT_BYTES[np.clip(left[:, None] - np.arange(0, STRIDE, 8), 0, 8)]
        by = np.lexsort([size[row], *words.T[::-1], *([group] if depth else [])])
        row, words = row[by], words[by]
        order[places] = row
        together = np.flatnonzero(group[1:] == group[:-1])
        differ = words[together] ^ words[together + 1]
        word = (differ != 0).argmax(1)
        first = differ[np.arange(len(differ)), word]
        equal = first == 0
        same = np.where(equal, STRIDE, 8 * word + 8 - np.searchsorted(BYTE_STEPS, first, "right"))
        depth += STRIDE
        shared[places[together + 1]] = depth - STRIDE + same
        # neighbours that are equal so far and both go on
        more = together[equal & (size[row[together]] > depth) & (size[row[together + 1]] > depth)]
        tied = np.zeros(len(places) + 1, bool)
        tied[more + 1] = True
        stays = tied[:-1] | tied[1:]
        group = np.cumsum(~tied[:-1])[stays]
        places = places[stays]
    shared[1:] = np.minimum(shared[1:], np.minimum(size[order[1:]], size[order[:-1]]))
    return order, shared


def _previous_smaller(value: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each place, the prefix shared with the nearest place before it of smaller value (0: none).

    Every place points at a place to its left with no smaller value between. All pointers that
    do not yet point at a smaller value take over their target's pointer, until none is left.
    """
    at = np.arange(len(value)) - 1
    reach = shared.copy()
    open_places = np.flatnonzero((reach > 0) & (at >= 0))
    while len(open_places := open_places[value[at[open_places]] >= value[open_places]]):
        target = at[open_places]
        next_at, next_reach = at[target], np.minimum(reach[open_places], reach[target])
        at[open_places], reach[open_places] = next_at, next_reach
        open_places = open_places[(next_reach > 0) & (next_at >= 0)]
    return reach


def longest_previous_factor(order: np.ndarray, shared: np.ndarray, document: np.ndarray, least: int = 1) -> np.ndarray:
    """For each suffix the length of its longest prefix that also starts in a document of smaller number.

    order and shared come from suffix_order. The match is with the previous or with the next
    suffix of a smaller document in suffix order, whichever shares more. Lengths below `least` count as 0.
    """
    value = document[order]
    shared = np.where(shared < least, 0, shared)
    before = _previous_smaller(value, shared)
    after = _previous_smaller(value[::-1], np.append(shared[1:], 0)[::-1])[::-1] if len(order) else before
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


# --- blocks and buckets ------------------------------------------------------------------


class Runs:
    """The runs of windows under one key in a block's documents, in order of doc_id."""

    def __init__(self, table: pa.Table, length: int) -> None:
        self.table, self.ids = in_id_order(table)
        self.length = length
        self.data, self.starts, self.ends = text_bytes(self.table.column("text"))
        n = len(self.data)
        self.window_key = np.zeros(n, np.uint64)
        keys = window_minimum(self.data, min(GRAM, length), length)
        # minima are small numbers: mixed again, they spread over all buckets
        self.window_key[: len(keys)] = mixed(keys) & ~LOW
        self._cut(self.window_key)

    def _cut(self, keys: np.ndarray) -> None:
        n = len(self.data)
        cut = np.zeros(n + 1, bool)
        cut[1:n] = keys[1:] != keys[:-1]
        cut[self.starts] = True
        cut[np.maximum(self.starts, self.ends - self.length + 1)] = True
        cut[n] = True
        at = np.flatnonzero(cut)
        first, size = at[:-1], np.diff(at)
        if len(size) and size.max() > LONGEST_RUN:
            parts = -(-size // LONGEST_RUN)
            step = ranges(np.zeros(len(parts), np.int64), parts) * LONGEST_RUN
            size = np.minimum(LONGEST_RUN, np.repeat(size, parts) - step)
            first = np.repeat(first, parts) + step
        doc = np.searchsorted(self.ends, first, "right")
        valid = first + self.length <= self.ends[np.minimum(doc, len(self.ends) - 1)] if len(self.ends) else np.zeros(0, bool)
        self.first, self.size, self.doc = first[valid], size[valid], doc[valid]
        self.key = keys[self.first]

    def split_hot(self, hot: np.ndarray) -> None:
        """File the windows under hot keys under all their bytes."""
        whole = gram_hashes(self.data, self.length) & ~LOW
        keys = self.window_key.copy()
        at = np.flatnonzero(_among(keys[: len(whole)], hot))
        keys[at] = whole[at]
        self._cut(keys)
        self.split = np.unique(whole[at])

    def fragments(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs under repeated keys, the number of the fragment each holds, and a run of each fragment.

        Fragments are numbered in order of key, and the run given is that of the least doc_id.
        """
        repeated = np.sort(repeated)  # answers come in any order
        hot = repeated[repeated & LOW == 2] & ~LOW
        wanted = repeated & ~LOW
        if len(hot):
            self.split_hot(hot)
            wanted = np.union1d(np.setdiff1d(wanted, hot), self.split)
        run = np.flatnonzero(_among(self.key, wanted))
        code = byte_hash(self.data, self.first[run], self.size[run] + self.length - 1)
        order = np.lexsort((code, self.size[run], self.key[run]))
        run, code = run[order], code[order]
        new = np.ones(len(run), bool)
        new[1:] = (self.key[run][1:] != self.key[run][:-1]) | (self.size[run][1:] != self.size[run][:-1]) | (code[1:] != code[:-1])
        copies = np.flatnonzero(~new)  # held to the bytes of the one before; one that differs stands for itself
        new[copies] = differing(self.data, self.first[run[copies]], self.first[run[copies - 1]], self.size[run[copies]] + self.length - 1)
        return run, np.cumsum(new) - 1, run[new]


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which keys are in wanted, which is sorted."""
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def differing(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which ranges of bytes from a and from b differ, 8 bytes at a time; every size is 8 or more."""
    out = np.zeros(len(size), bool)
    words = np.lib.stride_tricks.sliding_window_view(data, 8) if len(size) else data
    steps = -(-size // 8)
    for lo in range(0, len(size), PORTION):
        n = steps[lo : lo + PORTION]
        at = np.minimum(8 * ranges(np.zeros(len(n), np.int64), n), np.repeat(size[lo : lo + PORTION] - 8, n))
        left, right = (words[np.repeat(x[lo : lo + PORTION], n) + at].view(np.uint64)[:, 0] for x in (a, b))
        out[lo : lo + PORTION] = np.logical_or.reduceat(left != right, np.cumsum(n) - n)
    return out


def byte_hash(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, from two overlapping halves of their gram hashes' sums."""
    grams = gram_hashes(data, 8)
    total = np.zeros(len(grams) + 1, np.uint64)
    place = np.arange(len(grams), dtype=np.uint64)
    np.cumsum(grams, out=total[1:])
    linear = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(grams * place, out=linear[1:])
    last = first + size - 7
    plain = total[last] - total[first]
    # the sum of gram times place in the range
    return (linear[last] - linear[first] - plain * first.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + plain


def weigh_keys(table: pa.Table, hot: int) -> pa.Table:
    """Answer each block with its keys that several documents hold.

    The low bits of a key sent: 0 for one run in the block, 1 to 3 for several documents with
    few, more than 8, or more than 64 runs. The low bits of an answer: 1, or 2 if the key is hot.
    """
    keys, sizes = joined(table.column("keys"), "<u8")
    block = np.repeat(table.column("block").to_numpy(), sizes)
    base, low = keys & ~LOW, (keys & LOW).astype(np.int64)
    order = np.argsort(base, kind="stable")
    at = groups(base[order])
    if not len(at):
        return rows_table([], arrow_schema(ANSWERS))
    weight = np.add.reduceat(np.array([1, 2, 8, 64])[low[order]], at)
    size = np.diff(np.append(at, len(base)))
    mark = np.where(weight > hot, 2, np.where(weight > 1, 1, 0)).astype(np.uint64)
    marked = np.empty(len(base), np.uint64)
    marked[order] = np.repeat(mark, size)
    hit = np.flatnonzero(marked)
    hit = hit[np.argsort(block[hit], kind="stable")]
    rows = [(b, k, None, None, None, None, None) for b, k in dealt(block[hit], base[hit] | marked[hit])]
    return rows_table(rows, arrow_schema(ANSWERS))


def match_fragments(table: pa.Table, length: int) -> pa.Table:
    """Answer each block, per fragment, with the doc_id after which it goes, and the runs of
    its windows that start in an earlier document.

    That doc_id is BEFORE_ALL if an earlier document has all of the fragment, else the one it came with.
    """
    keys, sizes = joined(table.column("keys"), "<u8")
    if not len(keys):
        return rows_table([], arrow_schema(ANSWERS))
    place, least, size = (joined(table.column(c), t)[0] for c, t in (("place", "<u4"), ("least", "<i8"), ("size", "<u2")))
    row_bytes = np.add.reduceat(size.astype(np.int64), np.cumsum(sizes) - sizes)  # no row is empty
    packed = table.column("bytes").to_pylist()
    parts = [pa.decompress(p, int(n), "zstd", asbytes=True) for p, n in zip(packed, row_bytes)]
    data = np.frombuffer(b"".join([*parts, bytes(STRIDE)]), np.uint8)
    del packed, parts
    block = np.repeat(table.column("block").to_numpy(), sizes)
    size = size.astype(np.int64)
    first = np.cumsum(size) - size
    base = keys & ~LOW
    code = byte_hash(data, first, size)
    order = np.lexsort((least, code, size, base))
    several, place, least, size, first, block, base, code = (x[order] for x in (keys & np.uint64(1), place, least, size, first, block, base, code))
    new = np.ones(len(order), bool)
    new[1:] = (base[1:] != base[:-1]) | (size[1:] != size[:-1]) | (code[1:] != code[:-1])
    kind = np.cumsum(new) - 1  # the different fragments, in order of key
    head = np.flatnonzero(new)  # of each, the entry of the least doc_id

    # The suffixes that are ordered: of each different fragment those that start a window, if its
    # key has others, and of each further copy the longest, which is all of it. A fragment alone
    # under its key has none. Keys are taken in portions, as windows under different keys never match.
    at = groups(base)
    entries = np.diff(np.append(at, len(base)))
    kinds = np.repeat(np.add.reduceat(new.astype(np.int64), at), entries)
    suffixes = np.where(new & (kinds > 1), size - length + 1, (np.repeat(entries, entries) > 1).astype(np.int64))
    stop = np.cumsum(suffixes)
    start = stop - suffixes
    owner = np.repeat(np.arange(len(base)), suffixes)
    factor = np.zeros(len(owner), np.int64)
    ends = np.append(at[1:], len(base))
    lo = 0
    while lo < len(base):
        wanted = int(np.searchsorted(stop, start[lo] + PORTION, "right"))
        over = int(np.searchsorted(ends, lo, "right"))  # the key that starts here, and more while they fit
        hi = int(ends[max(over, int(np.searchsorted(ends, wanted, "right")) - 1)])
        part = slice(int(start[lo]), int(stop[hi - 1]))
        begin = ranges(first[lo:hi], suffixes[lo:hi])
        lengths = (first + size)[owner[part]] - begin
        factor[part] = longest_previous_factor(*suffix_order(data, begin, lengths), least[owner[part]], length)
        lo = hi
    some = np.flatnonzero(suffixes)
    covered = np.zeros(len(base), bool)
    covered[some] = factor[start[some]] >= size[some]

    # runs of windows with an earlier match, per different fragment that is not covered
    inside = np.flatnonzero((factor >= length) & ~covered[owner] & new[owner])
    step = np.ones(len(inside), bool)
    step[1:] = (inside[1:] != inside[:-1] + 1) | (owner[inside][1:] != owner[inside][:-1])
    run_from = inside[step]
    run_to = np.append(inside, -1)[np.flatnonzero(np.append(step[1:], True))] + 1 if len(inside) else inside
    run_owner = owner[run_from]
    run_kind = kind[run_owner]
    run_count = np.bincount(run_kind, minlength=len(head))
    run_begin = np.cumsum(run_count) - run_count
    runs_of = np.where(covered | (least != least[head][kind]), 0, run_count[kind])

    answer = np.flatnonzero(covered | (several == 1) | (runs_of > 0))
    answer = answer[np.argsort(block[answer], kind="stable")]
    count = runs_of[answer]
    pick = ranges(run_begin[kind[answer]], count)
    run_block, run_place = np.repeat(block[answer], count), np.repeat(place[answer], count)
    low = (run_from - start[run_owner])[pick].astype("<u4")
    high = (run_to - start[run_owner])[pick].astype("<u4")
    runs = {b: cols for b, *cols in dealt(run_block, run_place.astype("<u4"), low, high)}
    after = np.where(covered, BEFORE_ALL, least)[answer]
    rows = [(b, None, p, e, *runs.get(b, (None,) * 3)) for b, p, e in dealt(block[answer], place[answer], after)]
    return rows_table(rows, arrow_schema(ANSWERS))


def remove_repeated_bytes(docs: DataFrame, length: int = 50, layout: Layout | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept and kept_sha256, one row per document.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a
    smaller doc_id. kept is binary: a cut may fall inside a character.
    """
    if not 9 <= length <= 60_000:
        raise ValueError("a repeated string has 9 to 60,000 bytes")
    texts = id_and_text(docs)
    layout = layout or Layout.of(texts)
    blocks = blocked(texts, layout)
    buckets = layout.buckets

    def send_keys(table: pa.Table) -> pa.Table:
        runs = Runs(table, length)
        block = table.column("block")[0].as_py()
        order = np.argsort(runs.key, kind="stable")
        keys, ids = runs.key[order], runs.ids[runs.doc[order]]
        at = groups(keys)
        if not len(at):
            return rows_table([], arrow_schema(KEYS))
        end = np.append(at[1:], len(keys))
        several = ids[at] != ids[end - 1]
        low = np.where(several, 1 + (end - at > 8) + (end - at > 64), 0).astype(np.uint64)
        keys = keys[at] | low
        return rows_table([(b, block, k) for b, k in dealt(bucket_of(keys, buckets), keys)], arrow_schema(KEYS))

    def send_fragments(table: pa.Table, answers: pa.Table) -> pa.Table:
        repeated = joined(answers.column("keys"), "<u8")[0]
        if not table.num_rows or not len(repeated):
            return rows_table([], arrow_schema(FRAGMENTS))
        runs = Runs(table, length)
        block = table.column("block")[0].as_py()
        run, number, head = runs.fragments(repeated)
        if not len(run):
            return rows_table([], arrow_schema(FRAGMENTS))
        at = groups(number)
        ids = runs.ids[runs.doc[run]]
        several = np.maximum.reduceat(ids, at) != np.minimum.reduceat(ids, at)
        keys = runs.key[head] | several.astype(np.uint64)
        size = runs.size[head] + length - 1
        text = runs.data[ranges(runs.first[head], size)]
        stop = np.cumsum(size)
        rows = []
        begin = 0
        place = np.arange(len(head), dtype="<u4")
        # the run of the least doc_id stands first, as the sort by content is stable
        for b, k, p, l, s in dealt(bucket_of(keys, buckets), keys, place, ids[at], size.astype("<u2")):
            end = begin + len(k) // 8
            part = text[stop[begin] - size[begin] : stop[end - 1]].tobytes()
            rows.append((b, block, k, p, l, s, pa.compress(part, "zstd", asbytes=True)))
            begin = end
        return rows_table(rows, arrow_schema(FRAGMENTS))

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return rows_table([], arrow_schema(RESULT))
        runs = Runs(table, length)
        data, starts, ends, ids = runs.data, runs.starts, runs.ends, runs.ids
        gone = np.zeros(len(data), bool)
        repeated = joined(answers.column("keys"), "<u8")[0]
        place = joined(answers.column("place"), "<u4")[0]
        if len(repeated) and len(place):
            run, number, head = runs.fragments(repeated)
            least = np.full(len(head), NO_MATCH)
            least[place] = joined(answers.column("least"), "<i8")[0]
            edge = np.zeros(len(data) + 1, np.int32)
            later = run[least[number] < ids[runs.doc[run]]]
            np.add.at(edge, runs.first[later], 1)
            np.add.at(edge, runs.first[later] + runs.size[later] + length - 1, -1)
            # runs of windows that start in a document before the first one with the fragment
            run_place, low, high = (joined(answers.column(c), "<u4")[0].astype(np.int64) for c in ("run_place", "run_from", "run_to"))
            order = np.argsort(run_place, kind="stable")
            run_place, low, high = run_place[order], low[order], high[order]
            begin = np.searchsorted(run_place, number, "left")
            count = np.searchsorted(run_place, number, "right") - begin
            pick, of = ranges(begin, count), np.repeat(runs.first[run], count)
            np.add.at(edge, of + low[pick], 1)
            np.add.at(edge, of + high[pick] + length - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        texts_at = starts[starts < ends]
        fresh[texts_at] = gone[texts_at]
        removed, spans = (np.append(0, np.cumsum(x)) for x in (gone, fresh))
        kept = data[~gone].tobytes()
        rows = []
        for doc_id, lo, hi in zip(runs.table.column("doc_id").to_pylist(), starts, ends):
            text = kept[lo - removed[lo] : hi - removed[hi]]
            rows.append((doc_id, int(hi - lo), int(removed[hi] - removed[lo]), int(spans[hi] - spans[lo]), text, hashlib.sha256(text).hexdigest()))
        return rows_table(rows, arrow_schema(RESULT))

    keys = blocks.groupBy("block").applyInArrow(send_keys, KEYS)
    repeated = keys.groupBy("bucket").applyInArrow(lambda t: weigh_keys(t, hot), ANSWERS)
    fragments = per_block(blocks, repeated, send_fragments, FRAGMENTS)
    matches = fragments.groupBy("bucket").applyInArrow(lambda t: match_fragments(t, length), ANSWERS)
    return per_block(blocks, repeated.unionByName(matches), remove, RESULT)


NO_MATCH = np.iinfo(np.int64).max
BEFORE_ALL = np.iinfo(np.int64).min


def op1_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 50-byte strings that an earlier document holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
