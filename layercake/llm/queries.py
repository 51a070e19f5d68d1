"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

from layercake.llm.byte_bpe import op10_byte_bpe
from layercake.llm.chat_format import op6_chat_formatting
from layercake.llm.collocations import op13_collocations
from layercake.llm.decontaminate import op4_decontamination
from layercake.llm.line_dedup import op7_line_dedup
from layercake.llm.ngram_join import op5_ngram_join
from layercake.llm.packing import op12_packing
from layercake.llm.periodic_runs import op11_periodic_runs
from layercake.llm.pii import op9_pii
from layercake.llm.quality_rules import op2_quality_rules
from layercake.llm.sharding import op3_sharding
from layercake.llm.sql import SQL
from layercake.llm.toxicity import op1_toxicity
from layercake.llm.url_filter import op8_url_filter

QUERIES = {
    q.__name__: q
    for q in (
        op1_toxicity,
        op2_quality_rules,
        op3_sharding,
        op4_decontamination,
        op5_ngram_join,
        op6_chat_formatting,
        op7_line_dedup,
        op8_url_filter,
        op9_pii,
        op10_byte_bpe,
        op11_periodic_runs,
        op12_packing,
        op13_collocations,
    )
}
ORACLE = {name: sql for name, sql in SQL.items() if name in QUERIES}
