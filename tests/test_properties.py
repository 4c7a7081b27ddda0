"""Property tests for the driver-side helpers (names and the check-file format)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from carryover.functions import quote_ref, split_ref
from carryover.plans import parse_checks

name_part = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), min_size=1, max_size=12)


@given(st.lists(name_part, min_size=1, max_size=4))
def test_quote_then_split_roundtrips(parts):
    assert split_ref(quote_ref(parts)) == parts


statement_line = st.text(
    alphabet=st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp"), blacklist_characters="\n\r\x0b\x0c\x1c\x1d\x1e\x85"),
    min_size=1,
    max_size=30,
).filter(lambda s: s.strip() and not s.strip().startswith("--"))


@settings(max_examples=200)
@given(st.lists(st.tuples(st.one_of(st.none(), st.from_regex(r"[a-z ]{1,12}", fullmatch=True)), st.lists(statement_line, min_size=1, max_size=3)), max_size=6))
def test_blocks_become_checks(blocks):
    text_parts = []
    for label, lines in blocks:
        head = [f"-- ASSERT: {label}"] if label is not None else []
        text_parts.append("\n".join(["-- a comment", *head, *lines]))
    checks = parse_checks("\n\n".join(text_parts) + "\n")
    assert len(checks) == len(blocks)
    for check, (label, lines) in zip(checks, blocks):
        assert check.sql == "\n".join(lines)
        expected = label.strip() if label is not None else None
        assert check.assert_msg == expected


@given(st.lists(st.integers(min_value=-(2**63), max_value=2**63 - 1), max_size=50))
def test_hash_slices_recombine_to_the_exact_sum(hashes):
    from carryover.operators.validate import combine

    # the three Spark expressions: h >> 42 (arithmetic), (h >> 21) & mask, h & mask
    mask = (1 << 21) - 1
    metrics = {
        "rows": len(hashes),
        "_h_hi": sum(h >> 42 for h in hashes),
        "_h_mid": sum((h >> 21) & mask for h in hashes),
        "_h_lo": sum(h & mask for h in hashes),
    }
    assert combine(metrics) == {"rows": len(hashes), "hash_sum": sum(hashes)}
