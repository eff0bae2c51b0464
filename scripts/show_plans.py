"""Print the formatted physical plans of the flagship merge and of a
statement normaliser (static plans, AQE off, so the chosen joins show)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf: str = "/root/testdata/sf0.01") -> None:
    from tallyspark.operators import layouts as LY
    from tallyspark.operators.merge import merge_statement
    from tallyspark.plans import fixtures as FX
    from tallyspark.session import build_local_session

    spark = build_local_session(8, "plans")
    res = merge_statement(FX.merge_ledger(spark, sf), FX.merge_statement_rows(spark, sf))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("=== flagship: ledger after one statement ===")
    res.ledger.explain("formatted")
    grid, routed = FX.bac_card_grid(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.BAC_CARD)
    print("=== normaliser: BAC card ===")
    rows.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
