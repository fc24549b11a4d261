"""Names of cells from a compact dictionary, one Arrow batch at a time.

The dictionary is, for each kind of id, the sorted ids and one heap of all names. It is
sent to every executor once. A batch of cells holds far fewer series than cells, so ids
are looked up, by binary search, once per series and batch; nothing is shuffled.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packedts.schemas import CIRCUIT_TAG, LSP_TAG, SIGN_TAG, UID_KINDS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMES_TYPE = "metric string, lsp_id int, circuit_id int, power_sign string, tags map<string,string>, series_error string"
_ARROW_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
_NUMBER = re.compile(r"[+-]?\d+")


def compact_dictionary(uids: DataFrame) -> dict[str, tuple]:
    """Sorted ids, bounds and heap of the names of each kind. The caller has measured the entries."""
    table = uids.select("qualifier", "uid", F.col("name").cast("binary").alias("name")).toArrow()
    compact = {}
    for kind in UID_KINDS:
        entries = table.filter(pa.compute.equal(table.column("qualifier"), kind)).sort_by("uid")
        names = entries.column("name").to_pylist()
        bounds = np.concatenate([[0], np.cumsum([len(n) for n in names], dtype=np.int64)]) if names else np.zeros(1, np.int64)
        compact[kind] = (entries.column("uid").to_numpy().astype(np.int32), bounds, b"".join(names))
    return compact


def _names_of(ids, entries):
    """The name of every id, or None."""
    known, bounds, heap = entries
    if not len(known):
        return [None] * len(ids)
    place = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    found = known[place] == ids
    return [heap[bounds[p] : bounds[p + 1]].decode() if f else None for p, f in zip(place.tolist(), found.tolist())]


def _id_at(data, positions, id_size):
    """Big-endian ids that start at the given bytes, as the signed numbers the dictionary holds."""
    number = np.zeros(len(positions), np.uint32)
    for byte in range(id_size):
        number = number << np.uint32(8) | data[positions + byte]
    return number.view(np.int32)


def _int(name):
    """INT of a signed decimal number with nothing around it, in digits of the basic plane, else None."""
    if not _NUMBER.fullmatch(name) or max(name) > "\uffff":
        return None
    number = int(name)
    return number if -(2**31) <= number < 2**31 else None


def _promoted(metric, pairs):
    """The typed columns, the other tags and the first fault of one series."""
    typed = {LSP_TAG: None, CIRCUIT_TAG: None, SIGN_TAG: None}
    tags: dict[str, str] = {}
    fault = None if metric is not None else "unknown metric id"
    for key, name in pairs:
        if key is None:
            fault = fault or "unknown tag key id"
        elif name is None:
            fault = fault or "unknown tag value id"
        elif key == SIGN_TAG:
            typed[key] = name
        elif key in typed:
            number = _int(name)
            typed[key] = typed[key] if number is None else number
        else:
            tags.pop(key, None)  # the last of the tags with one key stays, in its place
            tags[key] = name
    return metric, typed[LSP_TAG], typed[CIRCUIT_TAG], typed[SIGN_TAG], list(tags.items()), fault


def name_batch(series_key, id_size, dictionary):
    """The names of each series key as a struct; null keys have none."""
    encoded = series_key.cast(pa.large_binary()).dictionary_encode()
    keys = encoded.dictionary.to_pylist()
    sizes = np.array([len(k) for k in keys], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(keys), np.uint8)
    counts = (sizes - id_size) // (2 * id_size)
    series = np.repeat(np.arange(len(keys)), counts)
    ordinal = np.arange(len(series)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[series] + id_size * (1 + 2 * ordinal)
    metrics = _names_of(_id_at(data, starts, id_size), dictionary["metrics"])
    tag_keys = _names_of(_id_at(data, at, id_size), dictionary["tagk"])
    values = _names_of(_id_at(data, at + id_size, id_size), dictionary["tagv"])
    ends = np.cumsum(counts).tolist()
    rows = [_promoted(m, zip(tag_keys[end - n : end], values[end - n : end])) for m, n, end in zip(metrics, counts.tolist(), ends)]
    columns = list(zip(*rows)) or [[]] * len(_ARROW_TYPES)
    fields = [part.split()[0] for part in NAMES_TYPE.split(", ")]
    named = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW_TYPES)], fields)
    return named.take(encoded.indices)


def series_names(series_key: Column, id_size: int, dictionary) -> Column:
    """Column struct of the names behind a series key; dictionary is a broadcast ``compact_dictionary``.

    Nondeterministic for the planner, like the point split, so that it runs once per cell.
    """

    def name(series_key: pa.Array) -> pa.Array:
        return name_batch(series_key, id_size, dictionary.value)

    return F.arrow_udf(name, NAMES_TYPE).asNondeterministic()(series_key)
