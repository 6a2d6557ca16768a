"""The registered queries of this folder and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .collocations import OP12_SQL, op12_collocations
from .decontamination import op6_decontamination
from .embedding_dedup import op3_embedding_dedup
from .line_dedup import OP4_SQL, op4_line_dedup
from .lm_scoring import op2_lm_scoring
from .near_dedup import op10_probminhash
from .pii_crf import op1_pii_crf
from .quality_ftrl import op8_quality_ftrl
from .secret_crf import op13_secret_crf
from .sentencepieces import op9_sentencepiece
from .spelling_variants import OP11_SQL, op11_spelling_variants
from .toxicity_cnn import op5_toxicity_cnn
from .url_filter import OP7_SQL, op7_url_filter

QUERIES = {f.__name__: f for f in (
    op1_pii_crf, op2_lm_scoring, op3_embedding_dedup, op4_line_dedup, op5_toxicity_cnn, op6_decontamination,
    op7_url_filter, op8_quality_ftrl, op9_sentencepiece, op10_probminhash, op11_spelling_variants,
    op12_collocations, op13_secret_crf,
)}

ORACLE = {"op4_line_dedup": OP4_SQL, "op7_url_filter": OP7_SQL, "op11_spelling_variants": OP11_SQL,
          "op12_collocations": OP12_SQL}
