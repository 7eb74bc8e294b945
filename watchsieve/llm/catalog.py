"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, gif, jaccard_join, license_scan, mixing_lm, packing, quality, quotation, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_quality": quality.op4_quality,
    "op5_bpe": bpe.op5_bpe,
    "op6_quotation": quotation.op6_quotation,
    "quoted_replies": quotation.quoted_replies,
    "op7_packing": packing.op7_packing,
    "op8_gif": gif.op8_gif,
    "gif_frames": gif.gif_frames,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_mixing_lm": mixing_lm.op10_mixing_lm,
}
SQL = {"op2_exact_dedup": exact_dedup.OP2_SQL, "op6_quotation": quotation.OP6_SQL, "quoted_replies": quotation.QUOTED_SQL}
