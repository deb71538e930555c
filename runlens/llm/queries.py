"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runlens.llm import decontaminate, flat_graph, license_scan, line_templates, phrase_mining, prefix_trie, topk_search
from runlens.llm.decontaminate import op10_decontaminate
from runlens.llm.flat_graph import op13_flat_graph
from runlens.llm.license_scan import op9_license_scan
from runlens.llm.line_templates import op5_line_templates
from runlens.llm.lm_score import op2_lm_score
from runlens.llm.near_dedup import op3_near_dedup
from runlens.llm.phrase_mining import op12_phrase_mining
from runlens.llm.prefix_trie import op11_prefix_trie
from runlens.llm.sentencepiece_codec import op1_sentencepiece
from runlens.llm.token_output import op6_token_output
from runlens.llm.topk_search import op4_topk_search
from runlens.llm.toxicity import op8_toxicity
from runlens.llm.warc import op7_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_lm_score": op2_lm_score,
        "op3_near_dedup": op3_near_dedup,
        "op4_topk_search": op4_topk_search,
        "op5_line_templates": op5_line_templates,
        "op6_token_output": op6_token_output,
        "op7_warc": op7_warc,
        "op8_toxicity": op8_toxicity,
        "op9_license_scan": op9_license_scan,
        "op10_decontaminate": op10_decontaminate,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_phrase_mining": op12_phrase_mining,
        "op13_flat_graph": op13_flat_graph,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_topk_search": topk_search.oracle(),
        "op5_line_templates": line_templates.oracle(),
        "op9_license_scan": license_scan.oracle(),
        "op10_decontaminate": decontaminate.oracle(),
        "op11_prefix_trie": prefix_trie.oracle(),
        "op12_phrase_mining": phrase_mining.oracle(),
        "op13_flat_graph": flat_graph.oracle(),
    }
