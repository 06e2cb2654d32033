"""Print the physical plan (AQE initial plan, formatted tree only) of the
main queries at a scale factor, for PLANS.md."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["eod_flags", "trade_ip_logins", "access_log_parse_strict", "app_log_typed",
         "login_event_order", "consumer_lag_total", "orders_json_decode"]


def main() -> None:
    from loglane.plans.queries import REGISTRY
    from loglane.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    for name in NAMES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            REGISTRY[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        scans = re.findall(r"\((\d+)\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?(?:PartitionFilters[^\n]*\n)?", text)
        details = [ln for ln in text.splitlines()
                   if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Arguments: hashpartitioning",
                                     "Join type", "Keys ["))]
        print(f"### {name}\n\n```\n{tree.strip()}\n")
        for d in details:
            print(d[:220])
        print("```\n")


if __name__ == "__main__":
    main()
