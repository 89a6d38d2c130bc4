"""Exact item-to-item cosine similarity over a threshold.

Items fall into blocks of bounded size. Spark brings pairs of blocks together, a task works out
the cosines of one pair of blocks with numpy, and only pairs over the threshold leave it. Items
with the very same content are computed once, as one representative.
"""

from .common import Similarity, kept
from .index import Index, ranked_lists, read_index, whole_table, write_index
from .lists import as_map, as_recs, from_pairs, sim_between, sim_of, top_similar, whole_lists
from .raters import rater_similarity
from .tags import tag_similarity
from .vectors import vector_similarity

__all__ = [
    "Index",
    "Similarity",
    "as_map",
    "as_recs",
    "from_pairs",
    "kept",
    "ranked_lists",
    "rater_similarity",
    "read_index",
    "sim_between",
    "sim_of",
    "tag_similarity",
    "top_similar",
    "vector_similarity",
    "whole_lists",
    "whole_table",
    "write_index",
]
