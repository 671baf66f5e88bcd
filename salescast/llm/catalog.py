"""Queries and SQL of this subpackage."""

from salescast.llm import ngram_join, url_filter
from salescast.llm.alignment import op13_token_alignment
from salescast.llm.decontamination import op5_decontamination
from salescast.llm.embedding_dedup import op1_embedding_dedup
from salescast.llm.language import op8_language_id
from salescast.llm.mixing import op7_mixing
from salescast.llm.ngram_join import op6_ngram_join
from salescast.llm.periodic_runs import op12_periodic_runs
from salescast.llm.quality import op4_quality_classifier
from salescast.llm.secrets import op2_secrets
from salescast.llm.sharding import op10_sharding
from salescast.llm.suffix_dedup import op3_suffix_dedup
from salescast.llm.token_counts import op9_token_counts
from salescast.llm.url_filter import op11_url_filter

QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_secrets, op3_suffix_dedup, op4_quality_classifier, op5_decontamination, op6_ngram_join,
    op7_mixing, op8_language_id, op9_token_counts, op10_sharding, op11_url_filter, op12_periodic_runs,
    op13_token_alignment)}
ORACLE: dict[str, str] = {"op6_ngram_join": ngram_join.ORACLE, "op11_url_filter": url_filter.ORACLE}
