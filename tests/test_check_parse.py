from carryover.plans import parse_checks
from carryover.plans.checks import copy_check_text, info_sql, register_check_text

TEXT = """\
-- header comment
-- ====

-- ASSERT: first
SELECT 1 AS ok

-- ASSERT: label survives blank lines

-- and comments
SELECT
  2 AS ok;

SELECT 'info' AS tbl
-- ASSERT: dangling label with a statement after no blank line
SELECT 3
"""


def test_statements_split_on_blank_lines():
    checks = parse_checks(TEXT)
    assert [c.assert_msg for c in checks] == [
        "first",
        "label survives blank lines",
        "dangling label with a statement after no blank line",
    ]
    assert checks[0].sql == "SELECT 1 AS ok"
    assert checks[1].sql == "SELECT\n  2 AS ok;"
    # an ASSERT line inside a block labels that whole block, which stays one statement
    assert checks[2].sql == "SELECT 'info' AS tbl\nSELECT 3"


def test_empty_text_has_no_checks():
    assert parse_checks("") == []
    assert parse_checks("-- only\n\n-- comments\n") == []


def test_generated_check_text_parses():
    checks = parse_checks(copy_check_text([("src.a", "dst.a"), ("src.b", "dst.b")]))
    assert sum(c.is_assertion for c in checks) == 4
    assert not checks[-1].is_assertion
    reg = parse_checks(register_check_text(["db.x", "db.y"], "ds", "2024-01-15"))
    assert sum(c.is_assertion for c in reg) == 6


def test_info_sql_quotes_and_aliases():
    sql = info_sql([("o'x", "db.t", "ds")], count_alias="table_rows")
    assert "`table_rows`" in sql and "`db`.`t`" in sql and "o\\'x" in sql
