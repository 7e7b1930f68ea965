"""The queries of the training-data operators; each applies one operator to its whole table."""

from . import bit_planes, byte_bpe, decontaminate, filter_audit, hard_negatives, license_scan, line_dedup, near_dup, packing, quality_ledger, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_line_winnowing": line_dedup.query,
    "op2_warc_derivatives": warc.query,
    "op3_license_automaton": license_scan.query,
    "op4_bit_planes": bit_planes.query,
    "op5_rule_ledger": quality_ledger.query,
    "op6_tensor_minhash": near_dup.query,
    "op7_packing": packing.query,
    "op8_toxicity_mil": toxicity.query,
    "op9_edit_decontamination": decontaminate.query,
    "op10_suffix_radix": suffix_dedup.query,
    "op11_filter_audit": filter_audit.query,
    "op12_ball_tree_negatives": hard_negatives.query,
    "op13_byte_bpe": byte_bpe.query,
}
ORACLE = {
    "op5_rule_ledger": quality_ledger.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_ball_tree_negatives": hard_negatives.ORACLE,
}
