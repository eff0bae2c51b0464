"""What the queries keep, in the shared scratch folder and in memory."""

import glob
import os
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq

from tallyspark.functions import similarity as S
from tallyspark.operators.merge import merge_batch
from tallyspark.plans.queries import QUERIES
from tallyspark.session import ensure_checkpoint_dir


def _tables(spark, path, n):
    day = "cast(date_add(date'1995-01-01', cast(id % 900 as int)) as timestamp)"
    made = {
        "lineitem": ["id + 1 AS l_orderkey", "cast(id % 4 as int) AS l_linenumber", "id * 7 % 2003 AS l_partkey", "id * 5 % 101 AS l_suppkey",
                     "round((id * 7919 % 104729) / 7, 2) AS l_extendedprice", "if(id % 3 = 0, 'O', 'F') AS l_linestatus", f"{day} AS l_shipdate"],
        "orders": ["id + 1 AS o_orderkey", "id * 3 % 500 AS o_custkey", "if(id % 2 = 0, 'O', 'F') AS o_orderstatus",
                   "round((id * 104729 % 15485863) / 11, 2) AS o_totalprice", f"{day} AS o_orderdate", "'2-HIGH' AS o_orderpriority"],
        "customer": ["id + 1 AS c_custkey", "concat('Customer ', id) AS c_name", "cast(id % 25 as int) AS c_nationkey",
                     "round(id * 1.5 - 900, 2) AS c_acctbal", "'BUILDING' AS c_mktsegment"],
        "events": ["id AS event_id", f"{day} AS ts", "id % 40 AS user_id", "if(id % 5 = 0, 'error', 'click') AS event_type", "id * 0.5D AS value", "concat('{', id, '}') AS props"],
    }
    for name, cols in made.items():
        spark.range(n).selectExpr(*cols).write.parquet(f"{path}/{name}.parquet")
    return path


def _files(root):
    return set(glob.glob(f"{root}/**/part-*", recursive=True))


def test_grids_of_all_layouts_are_kept_once_and_packed(spark, tmp_path):
    """q35_all_layouts keeps its statements once and its rows once, both
    as zstd Parquet, and nothing else of their size."""
    n = 4000
    sf = _tables(spark, str(tmp_path), n)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = _files(root)
    rows = QUERIES["q35_all_layouts"](spark, sf)
    kept, rest = {}, 0
    for f in _files(root) - before:
        if f.endswith(".parquet"):
            name = f.split("/tables/")[1].split("/")[0].rsplit("-", 1)[0]
            meta = pq.ParquetFile(f).metadata
            assert all(meta.row_group(g).column(c).compression == "ZSTD" for g in range(meta.num_row_groups) for c in range(meta.num_columns)), f
            kept[name] = kept.get(name, 0) + meta.num_rows
        else:
            rest += os.path.getsize(f)
    assert set(kept) == {"all-layouts", "normalised"}
    # 50 or 8 files' headers, preambles of 10 files in two layouts and of nations
    assert 6 * n < kept["all-layouts"] < 6 * n + 500
    assert rest < 100_000  # one row per file
    counts = {r["kind"]: r["count"] for r in rows.groupBy(rows["file"].substr(1, 4).alias("kind")).count().collect()}
    assert counts == {
        "bac_": sum((k + 1 + k % 4) % 50 != 0 for k in range(n)) + n, "san_": 2 * sum((k + 1) % 23 != 0 for k in range(n)),
        "fic_": sum(k % 25 % 7 != 6 for k in range(n)), "rev_": n}


def test_matches_of_a_batch_are_held_a_few_rows_at_a_time(monkeypatch):
    """the memory of a batch of compared blocks does not grow with its
    pairs, of which nearly all match here; steps of any size give the same."""
    rows, n = 48, 256
    lists = lambda f, kind: pa.array([[f(r, k) for k in range(n)] for r in range(rows)], pa.list_(kind))
    left, right = lists(lambda r, k: f"PAY REF {k % 100} {r}", pa.string()), lists(lambda r, k: f"PAY REF {k % 97} {r}", pa.string())
    weights, labels = lists(lambda r, k: k % 5 + 1, pa.int64()), lists(lambda r, k: f"f{k % 7}" if k % 11 else None, pa.string())
    tracemalloc.start()
    try:
        got = S._matches(left, right, weights, labels, 0.5).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(len(x) == n for x in got)
    pairs = rows * n * n
    assert peak < 16 * pairs, peak  # two numbers of eight bytes a pair

    few = [x.slice(7, 3) for x in (left, right, weights, labels)]
    for held in (1, 1 << 17, 1 << 40):
        monkeypatch.setattr(S, "HELD", held)
        assert S._matches(*few, 0.5).to_pylist() == got[7:10]
    assert S._matches(*[x.slice(0, 0) for x in few], 0.5).to_pylist() == []


def test_tables_of_the_fold_are_packed(spark):
    """what a merge of contested blocks keeps is zstd Parquet."""
    row = "timestamp_ntz'2024-01-05' AS date", "1D AS amount", "'A' AS account_name"
    ledger = spark.range(0, 40, 2).selectExpr(*row, "concat('TRANSFER REF ', 1000 + id) AS description")
    stmts = spark.range(60).selectExpr(
        *row, "concat('TRANSFER REF ', 1000 + id, if(id % 2 = 1, ' OK', '')) AS description", "id % 2 AS stmt_seq", "id AS row_no", "concat('f', id % 2) AS file")
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = _files(root)
    merge_batch(ledger, stmts).ledger.count()
    made = _files(root) - before
    assert made and all(f.endswith(".zstd.parquet") for f in made)
