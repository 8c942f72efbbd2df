"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from engagement_lake.llm import exact_dedup, licenses, reversed_search, voronoi
from engagement_lake.llm.exact_dedup import op13_exact_dedup
from engagement_lake.llm.licenses import op6_license_scan
from engagement_lake.llm.mixing import op4_mixing
from engagement_lake.llm.packing import op10_packing
from engagement_lake.llm.ppm import op2_ppm_scores
from engagement_lake.llm.quality_rules import op9_quality_rules
from engagement_lake.llm.reversed_search import op11_reversed_search
from engagement_lake.llm.sharding import op8_sharding
from engagement_lake.llm.shingle_join import op3_jaccard_join
from engagement_lake.llm.token_alignment import op12_token_alignment
from engagement_lake.llm.token_counts import op7_token_counts
from engagement_lake.llm.token_files import op5_token_files
from engagement_lake.llm.voronoi import op1_voronoi_knn

QUERIES = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_ppm_scores": op2_ppm_scores,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_mixing": op4_mixing,
    "op5_token_files": op5_token_files,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_reversed_search": op11_reversed_search,
    "op12_token_alignment": op12_token_alignment,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES = {
    "op1_voronoi_knn": voronoi.ORACLE,
    "op6_license_scan": licenses.ORACLE,
    "op11_reversed_search": reversed_search.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
