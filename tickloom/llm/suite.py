"""The queries of this subpackage and their SQL."""

from tickloom.llm import (
    bytespans,
    collocations,
    decontaminate,
    infill,
    jaccard,
    language,
    licenses,
    mixing,
    pieces,
    quality,
    secrets,
    shards,
    substrings,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_feistel_shards": shards.op3_feistel_shards,
    "op4_language_id": language.op4_language_id,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_substring_dedup": substrings.op7_substring_dedup,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_suffix_dedup": bytespans.op9_suffix_dedup,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "op11_fill_in_middle": infill.op11_fill_in_middle,
    "op12_collocations": collocations.op12_collocations,
    "op13_mix_sources": mixing.op13_mix_sources,
}

ORACLE = {
    "op1_license_scan": licenses.SQL,
    "op2_quality_rules": quality.SQL,
    "op6_benchmark_decontamination": decontaminate.SQL,
    "op7_substring_dedup": substrings.SQL,
    "op8_jaccard_join": jaccard.SQL,
    "op9_suffix_dedup": bytespans.SQL,
    "op11_fill_in_middle": infill.SQL,
    "op12_collocations": collocations.SQL,
    "op13_mix_sources": mixing.SQL,
}
