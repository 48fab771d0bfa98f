"""op2's checksum of the end of a payload: unsigned, over the last 32 bytes of what is read back."""

import zlib

import pyarrow.parquet as pq

from tidewright.llm import queries


def test_tail(spark, small):
    t = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    want = {}
    for d, text in zip(t["doc_id"], t["text"], strict=True):
        data = (text or "").encode()
        lines = max(1, -(-len(data) // 576))
        want[d] = zlib.crc32((data + b"\xff" * (576 * lines - len(data)))[-32:])
    assert {r.doc_id: r.tail_crc32 for r in queries.op2_media(spark, small).collect()} == want
