"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from millrace.llm import embeddings, linededup, resample
from millrace.llm.decontaminate import op5_decontamination
from millrace.llm.embeddings import op6_embeddings
from millrace.llm.extract import op8_extraction
from millrace.llm.licenses import op3_licenses
from millrace.llm.linededup import op12_lines
from millrace.llm.neardup import op4_simhash
from millrace.llm.packing import op1_packing
from millrace.llm.pii import op10_pii
from millrace.llm.resample import op13_resampling
from millrace.llm.scoring import op2_scoring
from millrace.llm.sharding import op7_sharding
from millrace.llm.toxicity import op9_toxicity
from millrace.llm.whitening import op11_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_scoring, op3_licenses, op4_simhash, op5_decontamination,
        op6_embeddings, op7_sharding, op8_extraction, op9_toxicity, op10_pii,
        op11_whitening, op12_lines, op13_resampling,
    )
}
ORACLES: dict[str, str] = {"op6_embeddings": embeddings.SQL, "op12_lines": linededup.SQL, "op13_resampling": resample.SQL}
