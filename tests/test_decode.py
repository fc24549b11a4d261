from datetime import datetime, timezone

import pytest
from vectors import R3, R4, at, cells_of, one_cell, row_key, uids_of

from packedts.operators.decode import decode_errors, decode_points
from packedts.schemas import POINTS

GOOD = {
    "int8": ("0000", "05", [(0, 5.0)]),
    "int16": ("03c1", "fffe", [(60, -2.0)]),
    "int32": ("03d3", "ffffffff", [(61, -1.0)]),
    "int64 rounds": ("03e7", "0020000000000001", [(62, 9007199254740992.0)]),
    "float32": ("e0fb", "3fc00000", [(3599, 1.5)]),
    "float32 widens": ("e0fb", "3dcccccd", [(3599, 0.10000000149011612)]),
    "last offset": ("e10f", "c002000000000000", [(3600, -2.25)]),
    "two points": ("0000 03c1", "05 fffe 00", [(0, 5.0), (60, -2.0)]),
    "append": ("050000", "0000 05 03c1 fffe", [(0, 5.0), (60, -2.0)]),
    "append has no limit": ("050000", "f000 05", [(3840, 5.0)]),
    "empty append": ("050000", "", []),
    "annotation of 3": ("010000", "7b7d", []),
    "annotation of 5": ("0100000000", "7b7d", []),
    "no qualifier": ("", "", []),
    "no qualifier, some value": ("", "ff", []),
    "unsigned qualifier": ("bb80", "05", [(3000, 5.0)]),
}

BAD = {
    "no trailer": ("0000 03c1", "05 fffe", "left over"),
    "trailer not zero": ("0000 03c1", "05 fffe 01", "left over"),
    "one byte over": ("0000", "05 00", "left over"),
    "value short": ("03c1", "05", "too short"),
    "offset 3601": ("e110", "05", "over one hour"),
    "milliseconds": ("f0000000", "05 05 00", "over one hour"),
    "width 3": ("0002", "010203", "unsupported value width"),
    "float of 2": ("0009", "0102", "unsupported value width"),
    "float of 1": ("0008", "01", "unsupported value width"),
    "append cut off": ("050000", "0000 05 03", "too short"),
    "append value cut off": ("050000", "0000 05 03c1 ff", "too short"),
    "append width 3": ("050000", "0002 010203", "unsupported value width"),
    "odd qualifier": ("020000", "05", "odd qualifier"),
    "odd qualifier of 5": ("0200000000", "05", "odd qualifier"),
    "one byte qualifier": ("01", "05", "odd qualifier"),
}


def rows(points):
    return sorted(points.collect(), key=lambda r: (r.version, r.idx))


@pytest.fixture(scope="module")
def uids(spark):
    return uids_of(spark).cache()


def test_good_cells(spark, uids):
    cells = cells_of(spark, [(R4, b"t", q, v, i) for i, (q, v, _) in enumerate(GOOD.values())])
    points = decode_points(cells, uids)
    assert points.schema.simpleString() == POINTS.simpleString()
    expected = [
        ("power", at(s).replace(tzinfo=None), x, 2400, 7, "p", {"site": "hq"}, i, idx)
        for i, (_, _, found) in enumerate(GOOD.values())
        for idx, (s, x) in enumerate(found)
    ]
    assert [tuple(r) for r in rows(points)] == expected


def test_bad_cells(spark, uids):
    cells = cells_of(spark, [(R4, b"t", q, v, i) for i, (q, v, _) in enumerate(BAD.values())])
    errors = {r.version: r.error for r in decode_errors(cells, uids).collect()}
    for i, (name, (_, _, text)) in enumerate(BAD.items()):
        assert text in errors[i], name


def test_good_cells_have_no_errors(spark, uids):
    cells = cells_of(spark, [(R4, b"t", q, v, i) for i, (q, v, _) in enumerate(GOOD.values())])
    assert decode_errors(cells, uids).count() == 0


@pytest.mark.parametrize("case", ["no trailer", "append cut off", "odd qualifier"])
def test_bad_cell_fails_the_job_and_names_the_file(spark, uids, case):
    q, v, text = BAD[case]
    cells = cells_of(spark, [(R4, b"t", "0000", "05", 0), (R4, b"t", q, v, 1)], file="store/f7")
    points = decode_points(cells, uids)
    for action in (points.collect, points.count):
        with pytest.raises(Exception, match=f"store/f7: .*{text}"):
            action()


def test_filters_do_not_hide_bad_cells(spark, uids):
    cells = cells_of(spark, [(R4, b"t", "0000", "05", 0), (row_key(), b"t", "0000", "05 00", 1)])
    points = decode_points(cells, uids)
    with pytest.raises(Exception, match="left over"):
        points.filter("lsp_id = 2400").collect()


def test_only_skips_cells_of_other_series(spark, uids):
    from pyspark.sql import functions as F

    cells = cells_of(spark, [(R4, b"t", "0000", "05", 0), (row_key(), b"t", "0000", "05 00", 1)])
    assert decode_points(cells, uids, only=F.col("lsp_id") == 2400).count() == 1


def test_other_families_are_not_even_checked(spark, uids):
    cells = cells_of(spark, [(b"\x00", b"id", "00", "05", 0), (R4, b"tt", "0000", "05", 1), (R4, b"", "0000", "05", 2)])
    assert decode_points(cells, uids).count() == 0


def test_annotations_are_not_checked(spark, uids):
    cells = cells_of(spark, [(row_key(metric=9), b"t", "010000", "7b", 0), (b"\x00", b"t", "0100000000", "", 1)])
    assert decode_points(cells, uids).count() == 0


def test_empty_cell_still_needs_names(spark, uids):
    assert decode_errors(one_cell(spark, "", "", key=row_key(metric=9)), uids).first().error == "unknown metric id"


KEYS = {
    "no tags": (row_key(), (None, None, None, {})),
    "circuit not a number": (row_key((2, 5)), (None, None, None, {})),
    "failed parse keeps the one before": (row_key((1, 1), (1, 5)), (2400, None, None, {})),
    "last parse wins": (row_key((1, 1), (1, 2)), (7, None, None, {})),
    "last tag wins": (row_key((4, 4), (4, 2)), (None, None, None, {"site": "7"})),
    "last sign wins": (row_key((3, 3), (3, 6)), (None, None, "x", {})),
    "tags keep apart": (row_key((4, 4), (5, 6)), (None, None, None, {"site": "hq", "rack": "x"})),
}


def test_row_keys(spark):
    cells = cells_of(spark, [(key, b"t", "0000", "05", i) for i, (key, _) in enumerate(KEYS.values())])
    uids = uids_of(spark, [(5, "tagk", "rack")])
    found = [(r.lsp_id, r.circuit_id, r.power_sign, r.tags) for r in rows(decode_points(cells, uids))]
    assert found == [names for _, names in KEYS.values()]


@pytest.mark.parametrize("text, number", [("+5", 5), ("-7", -7), ("007", 7), ("1.5", None), (" 12 ", None), ("", None), ("2147483647", 2147483647), ("2147483648", None), ("1e3", None), ("12\n", None), ("12\r\n", None), ("٣٤", 34), ("-１２", -12)])
def test_lenient_numbers(spark, text, number):
    uids = uids_of(spark, [(9, "tagv", text)])
    assert decode_points(one_cell(spark, "0000", "05", key=row_key((1, 9))), uids).first().lsp_id == number


def test_three_byte_ids(spark, uids):
    point = decode_points(one_cell(spark, "0000", "05", key=R3), uids, id_size=3).first()
    assert (point.metric, point.lsp_id, point.circuit_id, point.power_sign, point.tags) == ("power", 2400, None, None, {})


def test_key_faults(spark, uids):
    keys = {
        "row key of wrong length": [R3, R4[:-1], b"", b"\x00", R4 + b"\x00" * 4],
        "unknown metric id": [row_key(metric=9), row_key((9, 9), metric=9)],
        "unknown tag key id": [row_key((9, 1)), row_key((9, 9)), row_key((9, 1), (1, 9))],
        "unknown tag value id": [row_key((1, 9)), row_key((1, 9), (9, 1)), row_key((1, 1), (3, 3), (4, 9))],
    }
    flat = [(key, text) for text, listed in keys.items() for key in listed]
    cells = cells_of(spark, [(key, b"t", "0000", "05", i) for i, (key, _) in enumerate(flat)])
    assert {r.version: r.error for r in decode_errors(cells, uids).collect()} == dict(enumerate(t for _, t in flat))


def test_base_time_is_unsigned(spark, uids):
    point = decode_points(one_cell(spark, "0000", "05", key=row_key(base="80000000")), uids).first()
    assert point.time == datetime(2038, 1, 19, 3, 14, 8)


def test_high_bit_ids(spark):
    uids = uids_of(spark, [(-2, "metrics", "high")])
    assert decode_points(one_cell(spark, "0000", "05", key=row_key(metric=0xFFFFFFFE)), uids).first().metric == "high"


def test_provenance(spark, uids):
    cells = one_cell(spark, "0000", "05", key=row_key(salt="2a"))
    point = decode_points(cells, uids, provenance=True).first()
    assert (point.file, bytes(point.salt)) == ("f1", b"\x2a")


def test_cells_without_file_column(spark, uids):
    assert decode_points(one_cell(spark, "0000", "05").drop("file"), uids).count() == 1


def test_no_cells(spark, uids):
    assert decode_points(cells_of(spark, []), uids).count() == 0


def test_all_versions_are_kept(spark, uids):
    cells = cells_of(spark, [(R4, b"t", "0000", "05", 1), (R4, b"t", "0000", "06", 2)])
    assert [(r.version, r.value) for r in rows(decode_points(cells, uids))] == [(1, 5.0), (2, 6.0)]


@pytest.mark.parametrize("size", [0, 5])
def test_id_size_out_of_range(spark, uids, size):
    with pytest.raises(ValueError, match="1 to 4 bytes"):
        decode_points(one_cell(spark, "0000", "05"), uids, id_size=size)


def test_time_does_not_depend_on_the_session_zone(spark, uids):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        seconds = decode_points(one_cell(spark, "0000", "05"), uids).selectExpr("unix_seconds(time) s").first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seconds == datetime(2021, 4, 2, 10, tzinfo=timezone.utc).timestamp()
