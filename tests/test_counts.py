from test_decode import GOOD
from vectors import R4, cells_of, uids_of

from packedts.operators.counts import count_points, count_points_by_file, row_count, time_range
from packedts.operators.decode import decode_points


def test_qualifiers_are_counted_whatever_they_hold(spark):
    listed = [
        (b"t", "0000", 1),
        (b"t", "0000 03c1", 2),
        (b"t", "f0000000", 2),
        (b"t", "050000", 0),
        (b"t", "010000", 0),
        (b"t", "0100000000", 0),
        (b"t", "020000", 0),
        (b"t", "", 0),
        (b"id", "0000", 1),
        (b"t", "01", 0),
        (b"t", "00000000000000", 3),
    ]
    for file, rows in (("a", listed), ("b", listed[:2]), ("c", listed[3:5])):
        cells = cells_of(spark, [(R4, family, q, "05", 1) for family, q, _ in rows], file)
        expected = sum(n for _, _, n in rows)
        assert count_points(cells).first().points == expected
        assert [tuple(r) for r in count_points_by_file(cells).collect()] == [(file, expected)]


def test_no_cells_count_zero(spark):
    assert count_points(cells_of(spark, [])).first().points == 0


def test_count_equals_rows_for_packed_cells(spark):
    packed = [(q, v) for q, v, _ in GOOD.values() if len(bytes.fromhex(q.replace(" ", ""))) % 2 == 0]
    cells = cells_of(spark, [(R4, b"t", q, v, i) for i, (q, v) in enumerate(packed)])
    points = decode_points(cells, uids_of(spark))
    assert count_points(cells).first().points == row_count(points).first().points == points.count()


def test_time_range(spark):
    cells = cells_of(spark, [(R4, b"t", "0000 e10f", "05 c002000000000000 00", 1)])
    low, high = time_range(decode_points(cells, uids_of(spark))).first()
    assert (high - low).total_seconds() == 3600
