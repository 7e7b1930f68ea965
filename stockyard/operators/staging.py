"""Unified event tables from the change streams of different processes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import latest_by_key


def union_events(branches: list[tuple[DataFrame, dict[str, Column]]], schema: T.StructType) -> DataFrame:
    """Sources with different columns as one event table; what a branch does not map is a typed null."""
    parts = [df.select(*[mapped.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]) for df, mapped in branches]
    return reduce(DataFrame.unionByName, parts)


#: The workstation event sources. Timestamps fall back from left to right; 0 is a constant.
WORKSTATION_SOURCES: dict[str, dict] = {
    "RECEIVING": {"source": "inb_receive_item", "ts": ("receivedAt", "createdAt"), "user": "receivedBy", "hu": ("huId", "huCode"), "bin": "stagingBinId", "qty": ("receivedQty", "overallQty", "damagedQty"), "price": "price", "status": "reason", "reason": ("reason", "subReason"), "deactivated": "deactivatedAt"},
    "LOADING": {"source": "ob_load_item", "ts": ("loadedAt", "createdAt"), "user": "loadedBy", "hu": ("huId", "huCode"), "bin": "binId", "qty": ("loadedQty", "qty", 0), "status": "classificationType"},
    "PALLETIZATION": {"source": "inb_palletization_item", "ts": ("mappedAt", "updatedAt", "createdAt"), "user": "mappedBy", "hu": ("huId", "huCode"), "bin": "stagingBinId", "qty": ("qty", "qtyInside", 0), "price": "price", "status": "bucket", "reason": ("reason", "subReason"), "deactivated": "deactivatedAt"},
    "INBOUND_SERIALIZATION": {"source": "inb_serialization_item", "ts": ("serializedAt", "createdAt"), "user": "serializedBy", "hu": ("huId", "huCode"), "bin": "stagingBinId", "qty": ("qty", "qtyInside", 0), "status": "bucket", "reason": ("reason", "subReason"), "deactivated": "deactivatedAt"},
    "INBOUND_QC": {"source": "inb_qc_item_v2", "ts": ("updatedAt", "createdAt"), "user": "createdBy", "hu": ("parentItemId", None), "qty": ("actualQty", "receivedQty", 0), "price": "price", "status": "bucket", "reason": ("reason", "subReason"), "deactivated": "deactivatedAt"},
    "INVENTORY_ADJUSTMENT": {"source": "ira_bin_items", "ts": ("scannedAt", "approvedAt", "updatedAt", "createdAt"), "user": "scannedBy", "hu": ("sourceHUId", "sourceHUCode"), "bin": "binId", "qty": ("physicalQty", "systemQty", "physicalDamagedQty"), "status": "state", "reason": ("issue", None), "deactivated": "deactivatedAt"},
    "OUTBOUND_QA": {"source": "ob_qa_lineitem", "ts": ("updatedAt", "createdAt"), "user": "updatedBy", "hu": (None, None), "qty": ("pickedQty", "packedQty", "orderedQty"), "status": "skuCategory", "reason": ("skuClass", "uom")},
}

WORKSTATION_SCHEMA = (
    "event_type string, event_source_id string, event_timestamp timestamp, wh_id bigint, sku_id string, task_id string, session_id string, batch_id string, "
    "user_id string, hu_id string, hu_code string, bin_id string, primary_quantity bigint, secondary_quantity bigint, tertiary_quantity bigint, price double, "
    "status_or_bucket string, reason string, sub_reason string, created_at timestamp, deactivated_at timestamp"
)


def workstation_events(sources: dict[str, DataFrame]) -> DataFrame:
    """The seven workstation sources (by table name) as one event table; absent sources are left out."""
    col = lambda c: F.lit(c) if c is None or c == 0 else F.col(c)
    branches = []
    for kind, m in WORKSTATION_SOURCES.items():
        if m["source"] not in sources:
            continue
        hu, qty, reason = m["hu"], m["qty"], m.get("reason", (None, None))
        mapped = {
            "event_type": F.lit(kind), "event_source_id": F.col("id"), "event_timestamp": F.coalesce(*map(F.col, m["ts"])), "wh_id": F.col("whId"), "sku_id": F.col("skuId"),
            "task_id": F.col("taskId"), "session_id": F.col("sessionId"), "batch_id": F.col("batch"), "user_id": F.col(m["user"]), "hu_id": col(hu[0]), "hu_code": col(hu[1]),
            "bin_id": col(m.get("bin")), "primary_quantity": col(qty[0]), "secondary_quantity": col(qty[1]), "tertiary_quantity": col(qty[2]), "price": col(m.get("price")),
            "status_or_bucket": F.col(m["status"]), "reason": col(reason[0]), "sub_reason": col(reason[1]), "created_at": F.col("createdAt"), "deactivated_at": col(m.get("deactivated")),
        }
        branches.append((sources[m["source"]], mapped))
    return union_events(branches, T.StructType.fromDDL(WORKSTATION_SCHEMA))


def pick_drop(picks: DataFrame, mapping: DataFrame, drops: DataFrame, pick_key: list[str], pair_key: list[str], drop_key: list[str], pick_version: list, pair_version: list) -> DataFrame:
    """Latest picks, left-joined to the latest of their drops through the mapping; a mapping without its drop counts for nothing."""
    pairs = latest_by_key(mapping.join(drops, drop_key), pair_key, pair_version)
    return latest_by_key(picks, pick_key, pick_version).join(pairs, pick_key, "left")


def inventory_events(units: DataFrame, quants: DataFrame, key: str, quant_key: str) -> DataFrame:
    """Every handling-unit event with its quant events; quant_key is '' where there is none, as keys are never null."""
    out = units.join(quants, key, "left")
    return out.withColumn(quant_key, F.coalesce(F.col(quant_key).cast("string"), F.lit("")))
