"""Account patterns at size."""

from tallyspark.sources.accounts import read_accounts, screen_patterns


def test_more_accounts_than_the_driver_judges(spark):
    """patterns are judged by tasks, however many accounts there are."""
    n = 100_500
    names = spark.range(n).selectExpr("concat('A', id) AS account_name", "if(id % 1000 = 0, '(', concat('BAC ', id)) AS id_pattern")
    valid, bad = screen_patterns(names)
    assert sorted(bad) == sorted(f"A{k}" for k in range(0, n, 1000)) and valid.count() == n - len(bad)
    twice = spark.createDataFrame([("A", "("), ("A", "OK"), ("B", None), ("C", "[A-Z]")], "account_name string, id_pattern string")
    valid, bad = screen_patterns(twice)
    assert sorted(bad) == ["A", "B"] and [r["account_name"] for r in valid.collect()] == ["C"]


def test_accounts_are_parsed_once(spark, tmp_path):
    """what the accounts are read from later is a table, not the one JSON text."""
    (tmp_path / "a.json").write_text('{"A": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "X"}}')
    accounts = read_accounts(spark, str(tmp_path / "a.json"))
    assert "from_json" not in accounts._jdf.queryExecution().toString() and accounts.count() == 1
