"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import oracles
from .chat import op10_chat_tokens
from .decontaminate import op1_string_tiling
from .langid import op6_language_centroids
from .line_dedup import OP9_SQL, op9_line_winnowing
from .media_jpeg import op8_jpeg_columns
from .minhash import op7_near_duplicates
from .mixing import op2_temperature_mixture
from .pii import op5_personal_data
from .sharding import op4_bounded_ring
from .suffix_dedup import op3_repeated_bytes

def personal_data_counts(spark, sf_dir: str):
    """What SQL can express of op5_personal_data: the base spans of each kind."""
    return op5_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def jpeg_payloads(spark, sf_dir: str):
    """What SQL can express of op8_jpeg_columns: the bytes that come back from the stored images."""
    return op8_jpeg_columns(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def ring_slots(spark, sf_dir: str):
    """What SQL can express of op4_bounded_ring: the slots of each shard, but not which row is where."""
    return op4_bounded_ring(spark, sf_dir).select("shard", "slot", "law")


_ALL = (
    op1_string_tiling, op2_temperature_mixture, op3_repeated_bytes, op4_bounded_ring, op5_personal_data,
    op6_language_centroids, op7_near_duplicates, op8_jpeg_columns, op9_line_winnowing, op10_chat_tokens,
    personal_data_counts, jpeg_payloads, ring_slots,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLES = {
    "op3_repeated_bytes": oracles.REPEATED_BYTES,
    "op7_near_duplicates": oracles.NEAR_DUPLICATES,
    "op9_line_winnowing": OP9_SQL,
    "op10_chat_tokens": oracles.CHAT_TOKENS,
    "personal_data_counts": oracles.PERSONAL_DATA_COUNTS,
    "jpeg_payloads": oracles.JPEG_PAYLOADS,
    "ring_slots": oracles.RING_SLOTS,
}
