import pytest
from vectors import cells_of, uids_of

from packedts.operators.dictionary import ENTRY_BYTES, check_dictionary, dictionary_faults, read_uids

ENTRIES = [
    (b"power", b"id", b"metrics", "00000001", 1),
    (b"bot", b"id", b"tagk", "00000001", 1),
    (b"x", b"id", b"tagv", "000006", 1),
    (b"zero", b"id", b"tagv", "", 1),
    (b"high", b"id", b"tagv", "fffffffe", 1),
    (b"caf\xe9", b"id", b"tagv", "00000007", 1),
]
SKIPPED = [
    (b"\x00", b"id", b"metrics", "00000001", 1),
    (b"\x00\x00\x00\x01", b"name", b"metrics", "706f776572", 1),
    (b"long", b"name", b"metrics", "0000000001", 1),
]


def test_entries(spark):
    found = {(r.uid, r.qualifier, r.name) for r in read_uids(cells_of(spark, ENTRIES + SKIPPED)).collect()}
    assert found == {
        (1, "metrics", "power"),
        (1, "tagk", "bot"),
        (6, "tagv", "x"),
        (0, "tagv", "zero"),
        (-2, "tagv", "high"),
        (7, "tagv", "caf�"),
    }


def test_two_zero_bytes_are_a_name(spark):
    assert read_uids(cells_of(spark, [(b"\x00\x00", b"id", b"tagv", "01", 1)])).count() == 1


def test_long_id_raises_even_under_count(spark):
    uids = read_uids(cells_of(spark, [*ENTRIES, (b"y", b"id", b"tagv", "0000000001", 1)]))
    with pytest.raises(Exception, match="at most 4 bytes long, got 5"):
        uids.count()


def test_good_dictionary(spark):
    uids = uids_of(spark)
    assert check_dictionary(uids) == sum(len(r.name) + ENTRY_BYTES for r in uids.collect())


def test_empty_dictionary(spark):
    assert check_dictionary(uids_of(spark).limit(0)) == 0


@pytest.mark.parametrize(
    "extra, text, fault",
    [
        ((1, "metrics", "power2"), "duplicate UID: metrics 1", "duplicate id"),
        ((1, "metrics", "power"), "duplicate UID: metrics 1", "duplicate id"),
        ((1, "other", "x"), "unknown UID kind: other", "unknown kind"),
    ],
)
def test_bad_dictionary(spark, extra, text, fault):
    uids = uids_of(spark, [extra])
    with pytest.raises(ValueError, match=text):
        check_dictionary(uids)
    assert [r.fault for r in dictionary_faults(uids).collect()] == [fault]


def test_same_id_in_other_kinds_is_fine(spark):
    assert dictionary_faults(uids_of(spark)).count() == 0
