from decimal import Decimal

from carryover.operators import compare, subtract_fingerprint


def test_compare_counts_and_fingerprints():
    assert compare(10, 10) == ("success", None)
    status, why = compare(10, 9)
    assert status == "mismatch" and "10" in why and "9" in why
    assert compare(None, 3)[0] == "mismatch"
    fp = {"rows": 10, "hash_sum": Decimal(123)}
    assert compare(10, 10, fp, dict(fp)) == ("success", None)
    assert compare(10, 10, fp, {"rows": 10, "hash_sum": Decimal(124)}) == ("mismatch", "content fingerprint differs")


def test_fingerprint_subtraction_for_appends():
    before = {"rows": 5, "hash_sum": Decimal(-7)}
    after = {"rows": 12, "hash_sum": Decimal(40)}
    assert subtract_fingerprint(after, before) == {"rows": 7, "hash_sum": Decimal(47)}
    assert subtract_fingerprint(after, None) == after
