import pytest

from carryover.functions import (
    judge,
    path_stem,
    qualify,
    quote_ident,
    quote_ref,
    split_ref,
    sql_string,
    target_table_name,
)


def test_quote_and_split_roundtrip():
    assert quote_ident("a`b") == "`a``b`"
    assert split_ref("a.b.c") == ["a", "b", "c"]
    assert split_ref("`my.db`.t") == ["my.db", "t"]
    assert split_ref("`a``b`.c") == ["a`b", "c"]
    assert split_ref("` a `.t") == [" a ", "t"]  # quoted parts kept as written
    assert split_ref(" a . b ") == ["a", "b"]
    assert quote_ref("`my.db`.t") == "`my.db`.`t`"
    with pytest.raises(ValueError):
        split_ref("a..b")
    with pytest.raises(ValueError):
        split_ref("`a.b")


def test_qualify_keeps_database():
    assert qualify("t", "shop") == "`shop`.`t`"
    assert split_ref(qualify("t", "iceberg.sales")) == ["iceberg", "sales", "t"]  # catalog.database
    assert split_ref(qualify("t", "`my.db`")) == ["my.db", "t"]  # a dotted database name, quoted
    for bad in ("ab`c`", "`a` `b`", "db.x`t`"):
        with pytest.raises(ValueError):
            split_ref(bad)
    assert qualify("other.t", "shop") == "other.t"


def test_path_stems():
    assert path_stem("s3a://raw-parquet/yellow_tripdata") == "yellow_tripdata"
    assert path_stem("/x/yellow_tripdata/") == "yellow_tripdata"
    assert path_stem("/x/part.v1") == "part"
    assert path_stem("/x/a.b.parquet") == "a.b"


def test_table_names_from_paths_keep_dotted_folder_names():
    from carryover.functions import path_table_name

    assert path_table_name("/x/orders.parquet") == "orders"
    assert path_table_name("s3a://raw/yellow_tripdata/") == "yellow_tripdata"
    assert path_table_name("/data/sales.2024") == "sales.2024"  # refused later as a table name
    with pytest.raises(ValueError):
        target_table_name(path_table_name("/data/sales.2024"))


def test_target_names_rejected_when_not_identifiers():
    assert target_table_name("orders") == "orders"
    for bad in ("a.b", "*", "my-table", "1abc"):
        with pytest.raises(ValueError):
            target_table_name(bad)


def test_sql_string_escapes_quotes():
    assert sql_string("/p/it's") == "'/p/it\\'s'"
    assert sql_string('/p/"x"') == "'/p/\"x\"'"
    assert sql_string("a\\b") == "'a\\\\b'"


@pytest.mark.parametrize(
    "value,ok",
    [
        (True, True),
        (False, False),
        (None, False),
        (1, True),
        (0, False),
        (0.0, False),
        (2.5, True),
        ("", False),
        ("false", False),
        ("yes", False),
    ],
)
def test_assertion_truthiness(value, ok):
    passed, detail = judge(value)
    assert passed is ok
    if not ok:
        assert detail
