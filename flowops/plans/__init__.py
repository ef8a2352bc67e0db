from .chains import follow_chain, next_match
from .running import DEFAULT_MAX_ROWS, PART, Running, Split, join_parts, part_groups, plan_split, running, with_part
from .search import SearchTree, place_among, search_tree

__all__ = [
    "DEFAULT_MAX_ROWS",
    "PART",
    "Running",
    "SearchTree",
    "Split",
    "follow_chain",
    "join_parts",
    "next_match",
    "part_groups",
    "plan_split",
    "running",
    "with_part",
]
