"""Spark schemas of the tables. ASNs and counters are unsigned 32-bit values, held as bigint."""

from __future__ import annotations

ELEMENT = "seq bigint, ts double, elem_type string, prefix string, peer_asn bigint, as_path array<bigint>, origin_asns array<bigint>"
SNAPSHOT = "prefix string, origin_asn bigint, upstream_asn bigint, as_path array<bigint>, as_of timestamp, ts_start timestamp, collector string, source string, day date"
EVENT = "kind string, timestamp timestamp, org_a string, org_b string, asn_a bigint, asn_b bigint, domains_a array<string>, domains_b array<string>, prefix string, detail string"
FEATURE = (
    "asn_lo bigint, asn_hi bigint, org_lo string, org_hi string, prefix_move_days bigint, prefixes_moved bigint, new_adj_days bigint, "
    "upstream_converge_days bigint, first_seen timestamp, last_seen timestamp, persistence_days bigint, score bigint"
)
STATE = FEATURE.replace("persistence_days bigint, ", "")
SIGNAL = (
    "schema_version int, source string, kind string, as_of timestamp, prior_as_of timestamp, asn_a bigint, asn_b bigint, org_a string, org_b string, "
    "domains_a array<string>, domains_b array<string>, prefixes_moved bigint, prefix_move_days bigint, new_adj_days bigint, upstream_converge_days bigint, "
    "persistence_days bigint, score bigint, event_kinds array<string>, suppress_flags array<string>"
)
ORG = "org_id string, name string, asns array<bigint>, domains array<string>, prefix_count_hint bigint, external_id string, reg_order bigint"
ROA = "prefix string, max_length int, origin_asn bigint"
RELATION = "a bigint, b bigint, rel int"
CASE = "id string, expect_kind string, asn_a bigint, asn_b bigint, prefix string, window_start timestamp, window_end timestamp, expect_hit boolean, notes string"
ALERT = (
    "timestamp timestamp, prefix string, origin_asn bigint, as_path array<bigint>, peer_asn bigint, collector string, rpki_state string, "
    "path_verdict string, leak_suspected boolean, reason string"
)
