"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from packedts.llm.anchor_dedup import op9_anchor_dedup
from packedts.llm.cross_polytope import op8_cross_polytope
from packedts.llm.lang_id import op11_lang_id
from packedts.llm.lpf_dedup import op1_lpf_dedup
from packedts.llm.mixing import OP6_SQL, op6_mixing
from packedts.llm.mtree import OP3_SQL, op3_mtree
from packedts.llm.packing import op7_packing
from packedts.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from packedts.llm.secret_ledger import OP5_SQL, op5_secret_ledger
from packedts.llm.surrogates import op4_surrogates
from packedts.llm.tensor_minhash import op10_tensor_minhash
from packedts.llm.toxicity import op2_toxicity
from packedts.llm.whitening import op12_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_lpf_dedup,
        op2_toxicity,
        op3_mtree,
        op4_surrogates,
        op5_secret_ledger,
        op6_mixing,
        op7_packing,
        op8_cross_polytope,
        op9_anchor_dedup,
        op10_tensor_minhash,
        op11_lang_id,
        op12_whitening,
        op13_prefix_trie,
    )
}

ORACLES = {"op3_mtree": OP3_SQL, "op5_secret_ledger": OP5_SQL, "op6_mixing": OP6_SQL, "op13_prefix_trie": OP13_SQL}
