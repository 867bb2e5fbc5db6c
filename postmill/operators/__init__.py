"""DataFrame-to-DataFrame operators."""

from postmill.operators.columns import clean_columns, project
from postmill.operators.joins import label_lookup, left_join_dimension, unresolved_rows
from postmill.operators.merge import merge_rows
from postmill.operators.ranking import count_by, top_n

__all__ = [
    "clean_columns",
    "count_by",
    "label_lookup",
    "left_join_dimension",
    "merge_rows",
    "project",
    "top_n",
    "unresolved_rows",
]
