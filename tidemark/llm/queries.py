"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import code_books, exact_dedup, line_dedup, merkle, secret_scan, warc
from tidemark.llm.byte_codec import op2_byte_bpe
from tidemark.llm.near_dedup import op1_near_dedup
from tidemark.llm.packing import op3_best_fit_packing
from tidemark.llm.quality import op7_quality
from tidemark.llm.token_counts import op9_token_counts
from tidemark.llm.token_files import op8_token_files
from tidemark.llm.vector_search import op10_vector_search

QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_byte_bpe,
        op3_best_fit_packing,
        exact_dedup.op4_exact_dedup,
        secret_scan.op5_secret_scan,
        line_dedup.op6_line_dedup,
        op7_quality,
        op8_token_files,
        op9_token_counts,
        op10_vector_search,
        warc.op11_warc,
        code_books.op12_vector_codes,
        merkle.op13_merkle,
    )
}
ORACLES = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op5_secret_scan": secret_scan.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op11_warc": warc.SQL,
    "op12_vector_codes": code_books.sql(),
    "op13_merkle": merkle.SQL,
}
