
from __future__ import annotations

import json
import sys

GROUPS = [
    ("sensor join and per-hive aggregates", ("hive_count", "hive_average", "hive_filtered", "sensor_day_join", "daily_topology", "topology_", "subday_")),
    ("calendar buckets", ("bucket_",)),
    ("messages: parse, validate, encode", ("parse_", "quarantine_", "pick_", "reading_", "valid_", "readings_", "encode_")),
    ("upsert and streams", ("upsert_", "stream_")),
    ("windows and summaries", ("window_", "sensor_summary", "summary_", "hive_summary", "retention_")),
    ("transactions, baskets, lookup", ("txn_", "basket_", "range_")),
]


def main() -> None:
    data = json.loads(open(sys.argv[1]).read() if len(sys.argv) > 1 else sys.stdin.read())
    q = data["queries"]
    seen = set()
    print("| group | query | seconds |")
    print("|---|---|---|")
    for label, prefixes in GROUPS:
        for name, sec in q.items():
            if name in seen or not name.startswith(prefixes):
                continue
            seen.add(name)
            print(f"| {label} | `{name}` | {sec:.2f} |")
    for name, sec in q.items():
        if name not in seen:
            print(f"| other | `{name}` | {sec:.2f} |")
    print(f"| **all** | {len(q)} queries | **{data['value']:.1f}** |")
    if data.get("stream_messages_per_sec"):
        print(f"\nFile-fed sensor stream (feed write + ingest + compaction + read): "
              f"{data['stream_messages_per_sec']:.0f} messages/s.")


if __name__ == "__main__":
    main()
