"""Registered queries of this subpackage and their DuckDB SQL."""

from tillstream.llm.decontaminate import op5_benchmark_decontamination
from tillstream.llm.fim import OP11_SQL, op11_fill_in_middle
from tillstream.llm.langid import op4_language_id
from tillstream.llm.minhash import op7_document_fingerprints
from tillstream.llm.mixing import OP9_SQL, op9_mix_sources
from tillstream.llm.negatives import OP13_SQL, op13_hard_negatives
from tillstream.llm.packing import op12_pack
from tillstream.llm.quality import op8_quality
from tillstream.llm.secrets import op6_secret_scan
from tillstream.llm.simhash_dedup import op1_simhash_dedup
from tillstream.llm.suffix_lm import op3_lm_score
from tillstream.llm.toxicity import op10_toxicity
from tillstream.llm.urlfilter import op2_url_filter

QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_lm_score": op3_lm_score,
    "op4_language_id": op4_language_id,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_quality": op8_quality,
    "op9_mix_sources": op9_mix_sources,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_pack": op12_pack,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Queries that SQL can express; the others are tested against brute force.
SQL: dict[str, str] = {
    "op9_mix_sources": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
