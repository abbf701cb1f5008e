"""The registered queries of the training-data operators."""

from __future__ import annotations

from .common import Query
from .decontamination import contaminated_documents
from .exact import EXACT_SQL, exact_copies
from .extraction import page_texts
from .language import predicted_languages
from .lines import documents_without_repeated_lines
from .lm import document_scores
from .mixing import MIX_SQL, mixed_documents
from .neighbours import nearest_embeddings
from .perspectives import PERSPECTIVES_SQL, perspectives
from .repair import repaired_conversations
from .simhash import simhash_components
from .toxicity import toxic_documents
from .variants import spelling_variants

QUERIES: dict[str, Query] = {
    "op1_extraction": Query(page_texts),
    "op2_decontamination": Query(contaminated_documents),
    "op3_neighbours": Query(nearest_embeddings),
    "op4_lines": Query(documents_without_repeated_lines),
    "op5_toxicity": Query(toxic_documents),
    "op6_simhash": Query(simhash_components),
    "op7_recurrent": Query(document_scores),
    "op8_perspectives": Query(perspectives, PERSPECTIVES_SQL),
    "op9_mixing": Query(mixed_documents, MIX_SQL),
    "op10_language": Query(predicted_languages),
    "op11_variants": Query(spelling_variants),
    "op12_repair": Query(repaired_conversations),
    "op13_exact": Query(exact_copies, EXACT_SQL),
}
