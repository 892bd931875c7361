"""Write PLANS.md: the physical plans of the main operators at sf0.01
(``explain("formatted")`` headers), so pushdown, broadcast and partial
limits can be checked without running anything else."""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cellhouse.operators.lookup import bulk_get, maybe_requested  # noqa: E402
from cellhouse.operators.maintain import compact  # noqa: E402
from cellhouse.operators.mutate import bulk_delete  # noqa: E402
from cellhouse.operators.ranges import RANGE, even_ranges, numbered_values  # noqa: E402
from cellhouse.operators.sort import rows_in_order  # noqa: E402
from cellhouse.plans import fixtures as fx  # noqa: E402
from cellhouse.plans.cell_queries import _requests, _users, customer_table, event_table, order_table  # noqa: E402
from cellhouse.plans.text_queries import _word_count  # noqa: E402
from cellhouse.session import build_session  # noqa: E402
from cellhouse.sources.table import read_cells, read_table  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    # keep the tree and the scan details (pushdown / pruning lines)
    head, _, detail = text.partition("\n\n\n")
    keep = [ln for ln in detail.splitlines()
            if ln.startswith(("(", "PartitionFilters", "PushedFilters", "ReadSchema", "Arguments: hashpartitioning",
                              "Join type", "Arguments: [row"))]
    return head.strip() + "\n\n" + "\n".join(keep)


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the main operators", "",
           f"Generated by `tools/dump_plans.py` at `{d}` (local[8], 16 shuffle partitions, AQE on).", ""]

    ev = fx.tbl(spark, d, "events")
    t = event_table(spark, d)
    bulk_delete(t, _users(ev, F.col("user_id") % 10 == 0), scope="row", ts=fx.T_DEL)
    sections = [
        ("Visible cells with row deletes (A6): tombstones aggregated and broadcast, newest-1 as a partial "
         "WindowGroupLimit before the only exchange of the puts", read_table(t)),
        ("Newest 3 versions: dense_rank limit, partial before the exchange, per-ts dedup without a second "
         "exchange", read_table(t, versions=3)),
    ]
    ot = order_table(spark, d)
    sections.append(("Row-range + column scan (S7): row bounds pushed to parquet, region and family as "
                     "partition filters", read_table(ot, start_row=f"{3000:019d}", stop_row=f"{9000:019d}",
                                                     families=["price"], qualifiers=["o_totalprice"])))
    sections.append(("Lookup (J1): key range pushed down, broadcast key semi join before visibility, "
                     "left join back", bulk_get(_requests(spark, d), customer_table(spark, d),
                                                [("info", "c_name", "c_name")])))
    sections.append(("Visible cells beyond the broadcast bound (A6): puts and tombstones through one exchange, no join",
                     read_table(t, broadcast_bytes=0)))
    asked = fx.tbl(spark, d, "lineitem").where("l_orderkey % 3 = 0").select(fx.padded_key("l_orderkey").alias("row"))
    keys = asked.distinct()
    cells = read_cells(ot)
    n, near = cells.count(), maybe_requested(cells, keys, keys.count()).count()
    sections.append((f"Lookup beyond the broadcast bound (J1): hash filter of the keys before the shuffle of the table; here "
                     f"{near} of {n} cells pass it", bulk_get(asked, ot, [("price", "o_totalprice", "p")], broadcast_bytes=0)))
    sections.append(("Ranks by regions (O4): one exchange by region, read by the counts and by the places",
                     rows_in_order(read_table(ot), ot.starts)))
    hot = fx.tbl(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(
        F.col("l_orderkey")).alias("k"), "l_orderkey")
    ranged = even_ranges(hot, "k", "l_orderkey", n=16)
    sizes = sorted(r["count"] for r in ranged.groupBy(RANGE).count().collect())
    sections.append((f"Even ranges with a third of all rows under one key (U2): rows a range, least {sizes[0]}, median {sizes[8]}, "
                     f"most {sizes[-1]}; places of a hot key's values by a broadcast of its pieces (A1)",
                     numbered_values(hot.select(F.col("k"), "l_orderkey"), "k", ("l_orderkey",), 16)))
    ct = order_table(spark, d, "compacted", loads=2)
    compact(ct, major=True, keep_versions=1)
    sections.append(("Scan of a major-compacted table: groups already resolved, no exchange at all",
                     read_table(ct)))
    sections.append(("Word count (A2): partial + final hash aggregate", _word_count(spark, d)))
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
