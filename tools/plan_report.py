"""Write PLANS.md: the physical-plan shape of every batch query at one scale.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inboxlens.plans.catalog import BATCH_QUERIES  # noqa: E402
from inboxlens.session import build_session  # noqa: E402

NOTES = """\
## Plan decisions made while building 

* **One JSON parse per message.** A `from_json` projection followed by the contract
  filter let Catalyst push the filter below the projection and re-inline the parse
  into each check (about 11 parses per row; with field pruning each a separate
  `from_json`). The decoder uses `json_tuple` (a Generate node, which filters cannot
  cross) plus `try_cast`: 400k messages decoded in 1.3 s instead of 5.7 s.
* **Geography joins.** Catalyst estimates a join's size as the product of its inputs,
  so `customer ⋈ nation ⋈ region` looked huge and forced a sort-merge join (and a
  shuffle of all events) even for a 15k-row customer table. Joining events to
  `customer` first and the fixed-size nation/region tables last lets the size check
  see the customer scan alone: broadcast while small, sort-merge join beyond.
  `json_roundtrip_events` went from 2 shuffles to 0, `events_by_campaign_city` from 3 to 1.
* **Pre-aggregate before per-row regexes.** `client_mix` counts per (campaign, agent)
  first and classifies each distinct pair once (0.8 s instead of 2.1 s at sf0.1).
* **Landing in one write.** The landed topic is written once, range-partitioned by event time.
* **Streams without AQE.** Micro-batches plan once, without runtime re-planning. The streaming
  enrichment counts each batch's own keys and splits those that a task could not take.
* **Null keys.** A salt in a column of its own is folded away (the dimension's salt is a
  literal), so the salt stands in the join key itself.
"""


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|"
                                   r"RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)[^\n]*?"
                            r"(Inner|LeftOuter|LeftSemi|LeftAnti)", plan),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/([a-z]+)\.parquet\][^\n]*?"
                            r"PushedFilters: \[([^\]]*)\]", plan),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    lines = [f"# Physical plans of the batch queries ({os.path.basename(sf)}, static plans before AQE)", "",
             "| query | shuffles | broadcasts | windows | joins | scans: table [columns] (pushed filters) |",
             "|---|---|---|---|---|---|"]
    for name, fn in BATCH_QUERIES.items():
        s = summary(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
        joins = ", ".join(f"{j[0].replace('Join', '')}/{j[1]}" for j in s["joins"]) or "—"
        scans = "; ".join(f"{t} [{re.sub(r'#[0-9]+L?', '', c)}]" + (f" ({re.sub(r'#[0-9]+L?', '', f)})" if f else "")
                          for c, t, f in s["scans"])
        lines.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['windows']} | {joins} | {scans} |")
    flagship = BATCH_QUERIES["campaign_effectiveness"](spark, sf)
    formatted = flagship._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = formatted.split("\n\n")[0]  # the operator tree; node details omitted
    lines += ["", "## Flagship query: campaign_effectiveness (`explain(\"formatted\")` tree)", "",
              "```", head.strip(), "```", "", NOTES]
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(lines))
    print(out)


if __name__ == "__main__":
    main()
