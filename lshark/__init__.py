"""lshark: set similarity and collaborative-filtering recommendation on Spark.

Everything is expressed with DataFrame / SQL operators so Catalyst plans the
work: MinHash signatures are grouped ``min`` aggregates, LSH candidates are
equi-joins on (table, hash), verification is a join plus array arithmetic and
recommendation is join + aggregate + window top-k.
"""

from lshark.functions.minhash import MinHashModel, fit
from lshark.session import checkpoint_dir, get_session

__all__ = ["MinHashModel", "fit", "get_session", "checkpoint_dir"]
