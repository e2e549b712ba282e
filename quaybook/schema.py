"""Record types. Times are epoch milliseconds; `ord` gives the order within a market."""

from __future__ import annotations

LEVEL = "struct<price:string,quantity:string>"
OWNED_LEVEL = "struct<price:string,quantity:string,source_id:string>"
#: null: the event says nothing about the side; empty: the side is empty.
SIDE = f"array<{LEVEL}>"

STAGES = ("pair_extract", "type_validate", "rebase", "precision", "book_build")
TIMINGS = "struct<" + ",".join(f"{s}_{way}:bigint" for s in STAGES for way in ("in", "out")) + ">"

FRAME = "topic string, partition int, offset bigint, value string, processing_time bigint"
RAW_EVENT = f"exchange_id int, pair_id int, ord bigint, type string, simulation int, id string, source_ids array<string>, sequence_id bigint, sequence_jump bigint, event_time bigint, asks {SIDE}, bids {SIDE}"
SNAPSHOT = f"exchange_id int, pair_id int, ord bigint, simulation int, id string, trigger_id string, event_time bigint, last_sequence_id bigint, asks array<{OWNED_LEVEL}>, bids array<{OWNED_LEVEL}>"
EXCHANGE_BOOK = "struct<exchange_id:int,simulation:int,source_id:string,price:string,quantity:string>"
AGGREGATED = f"pair_id int, side string, ord bigint, id string, event_time bigint, levels array<{EXCHANGE_BOOK}>"
MERGED_LEVEL = "struct<simulation:int,exchange_ids:array<int>,source_ids:array<string>,price:string,quantity:string>"
MERGED = f"pair_id int, side string, ord bigint, id string, source_id string, event_time bigint, levels array<{MERGED_LEVEL}>"

#: Kafka topics of the stages, and how long they are kept.
STAGE_TOPICS = ("raw-flink", "type-validated-raw-flink", "rebased-flink", "applied-precision-flink", "orderbook-snapshot-flink")
REJECTED_TOPIC = "rejected-flink"
CONTROL_TOPIC = "control-plane"
